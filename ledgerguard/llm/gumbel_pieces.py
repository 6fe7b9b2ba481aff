"""SentencePiece encoding and decoding with segmentations sampled without replacement.

All pieces of the model that match the text form a lattice; a piece costs by
its rank (Zipf's law, sharpened by ``alpha``), so a path's probability is a
softmax over all segmentations. Sampling is Gumbel top-k: a perturbed A-star
search from the left expands a prefix into its next pieces with Gumbel noise
conditioned on the prefix's own perturbed score, which is the greatest of all
segmentations below it. The best open prefix is expanded first; complete
segmentations come out in the order of their perturbed scores, which is a
sample without replacement, with the probability of inclusion above the score
that just missed.

No piece crosses the start of a word, so the lattice is a chain of word
lattices; a word's conditional probabilities are computed once and kept. Noise
comes from a generator seeded by the row's key alone.

``sample`` searches one text, ``sample_many`` many at once with arrays. Two
observations make that cheap. The prefix that is expanded goes on along the
child that keeps its score, and that child is a draw from the conditional
probabilities: the whole path is drawn first, all words of all texts at once.
And the other children on its way matter only while the path is likely: at a
prefix of log-probability ``phi`` some noise lifts one above the k + 1 greatest
scores found so far with probability exp(phi - floor) at most. Where that is
below what a uniform of 53 bits can show, they are not looked at.
"""

from __future__ import annotations

import math
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import arrow_map, mix

SPACE = "▁"
_CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: -log of the least exponential that a uniform of 53 bits gives, rounded up.
RARE = 38.0
#: Bytes of text that are searched together: a word that comes again costs nothing.
SLICE_BYTES = 3 << 20
#: Words of the texts that are searched at a time.
GROUP_WORDS = 1 << 17
#: Characters at a word's end that it shares with the words that end alike.
SHARED = 32
#: Places of paths whose other children are scored at a time.
CHILDREN = 1 << 17


class Lattice:
    """Pieces, scores and word lattices of one SentencePiece model."""

    WORDS = 1 << 15  # kept word lattices

    def __init__(self, path: str, alpha: float = 1.0, shift: float = 10.0):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(SPACE in p.lstrip(SPACE) for p in map(self.pieces.__getitem__, normal)):
            raise ValueError("a piece crosses the start of a word")
        # rank by the model's own order: its scores fall with the rank
        order = sorted(normal, key=lambda i: (-model.get_score(i), i))
        self.score = {self.pieces[i]: (i, -alpha * math.log(shift + r)) for r, i in enumerate(order)}
        self.byte_score = -alpha * math.log(shift + n)
        self.longest = max(map(len, self.score))
        self.starts = {p[:j] for p in self.score for j in range(1, len(p) + 1)}
        self.kept: dict[str, list] = {}
        self._arrays(n)

    def _arrays(self, n: int) -> None:
        """Scores by id, the pieces' bytes, and the prefixes as a trie in a hash table, for ``Chains``."""
        self.scores = np.zeros(n)
        for i, w in self.score.values():
            self.scores[i] = w
        self.binary = pa.array([bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.encode()
                                for p in self.pieces], pa.binary())
        self.byte_ids = np.array([self.bytes.get(x, -1) for x in range(256)], np.int64)
        state = {p: i for i, p in enumerate(sorted(self.starts, key=len))}
        self.piece_at = np.full(len(state), -1, np.int64)
        for p, (i, _) in self.score.items():
            self.piece_at[state[p]] = i
        self.root = np.full(0x110000, -1, np.int64)
        bits = (4 * len(state)).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots, self.to = np.full((1 << bits) + len(state), -1, np.int64), np.full((1 << bits) + len(state), -1, np.int64)
        for p, i in state.items():
            if len(p) == 1:
                self.root[ord(p)] = i
                continue
            key = state[p[:-1]] << 21 | ord(p[-1])
            at = (key * int(GOLDEN) & (1 << 64) - 1) >> 64 - bits
            while self.slots[at] >= 0:
                at += 1
            self.slots[at], self.to[at] = key, i

    def follow(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The prefix one character longer, -1 if no piece starts with it."""
        key = state << 21 | code
        at = (key.view(np.uint64) * GOLDEN >> self.shift).view(np.int64)
        there = self.slots[at]
        out = np.where(there == key, self.to[at], -1)
        more = np.flatnonzero((there != key) & (there >= 0))
        while len(more):
            at[more] += 1
            there = self.slots[at[more]]
            same = there == key[more]
            out[more[same]] = self.to[at[more[same]]]
            more = more[~same & (there >= 0)]
        return out

    def word(self, text: str) -> list:
        """For each place of ``text``, its next pieces: [(ids, end, log-probability given the place)...]."""
        found = self.kept.get(text)
        if found is None:
            found = self._word(text)
            if len(text) <= 32:
                if len(self.kept) >= self.WORDS:
                    self.kept.clear()
                self.kept[text] = found
        return found

    def _word(self, text: str) -> list:
        n = len(text)
        rest, out = [0.0] * (n + 1), [None] * n
        for a in range(n - 1, -1, -1):
            edges = []
            for b in range(a + 1, min(n, a + self.longest) + 1):
                piece = text[a:b]
                if piece not in self.starts:
                    break
                hit = self.score.get(piece)
                if hit:
                    edges.append(((hit[0],), b, hit[1] + rest[b]))
            if not edges or edges[0][1] != a + 1:  # a character without a piece: its bytes
                ids = tuple(self.bytes[x] for x in text[a].encode())
                edges.append((ids, a + 1, len(ids) * self.byte_score + rest[a + 1]))
            top = max(w for _, _, w in edges)
            rest[a] = top + math.log(sum(math.exp(w - top) for _, _, w in edges))
            out[a] = [(ids, b, w - rest[a]) for ids, b, w in edges]
        return out


def escape(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def decode(ids, pieces: list[str]) -> str:
    """The text of piece ids; the inverse of every segmentation of a text without U+2581."""
    out = bytearray()
    for i in ids:
        p = pieces[i]
        out += bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.encode()
    text = out.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def sample(lattice: Lattice, text: str, k: int, seed: int) -> list[tuple[list[int], float, float, float]]:
    """Up to ``k`` distinct segmentations: (ids, log-probability, perturbed score, inclusion probability).

    Fewer come out only if there are no more; each is then certain (1.0).
    """
    words = [lattice.word(w) for w in _CHUNKS(escape(text))]
    if not words:
        return [([], 0.0, 0.0, 1.0)][:k]
    random = np.random.Generator(np.random.Philox(key=seed))
    noise, at = random.gumbel(size=512).tolist(), 0
    exp, log1p, log = math.exp, math.log1p, math.log
    # open prefixes, best first: (-perturbed, number, log-probability, word, place, path)
    queue = [(-noise[0], 0, 0.0, 0, 0, None)]
    at, number, done = 1, 1, []
    floor = [noise[0]]  # the k+1 greatest perturbed scores, open or done, least first
    last = len(words)
    while queue and len(done) <= k:
        g, _, phi, w, a, path = heappop(queue)
        g = -g
        while w < last:  # along the child that keeps the prefix's score
            word = words[w]
            edges = word[a]
            if len(edges) == 1:
                path, a = (path, edges[0][0]), edges[0][1]
            else:
                m = len(edges)
                if at + m > len(noise):
                    noise, at = random.gumbel(size=4096).tolist(), 0
                raw = [phi + e[2] + noise[at + i] for i, e in enumerate(edges)]
                at += m
                top = max(raw)
                least = floor[0] if len(floor) > k else -math.inf
                follow = None
                for e, x in zip(edges, raw):
                    if x == top and follow is None:
                        follow = e
                        continue
                    # the noise given that the greatest child equals g
                    v = g - x + log1p(-exp(x - top)) if x < top else -math.inf
                    score = g - max(0.0, v) - log1p(exp(-abs(v))) if v > -math.inf else g
                    if score > least:
                        whole = e[1] == len(word)
                        heappush(queue, (-score, number, phi + e[2], w + whole, 0 if whole else e[1], (path, e[0])))
                        number += 1
                        heappush(floor, score)
                        if len(floor) > k:
                            if len(floor) > k + 1:
                                heappop(floor)
                            least = floor[0]
                phi, path, a = phi + follow[2], (path, follow[0]), follow[1]
            if a == len(word):
                w, a = w + 1, 0
        done.append((path, phi, g))
    missed = done[k][2] if len(done) > k else -math.inf
    out = []
    for path, phi, g in done[:k]:
        ids: list[int] = []
        while path:
            path, piece = path
            ids += piece[::-1]
        chance = 1.0 if missed == -math.inf else -math.expm1(-exp(min(700.0, phi - missed)))
        out.append((ids[::-1], phi, g, chance))
    return out


class Chains:
    """The lattices of many words at once: nodes numbered by their distance from the word's end (0), edges by node.

    What follows a place depends on the rest of its word alone, so words share
    the nodes of their last ``SHARED`` characters with those that end alike.
    """

    def __init__(self, model: Lattice, words: list[str] | tuple[np.ndarray, np.ndarray]):
        """``words``: strings, or the code points of all and how many each has."""
        if isinstance(words, list):
            codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
            words = codes, np.fromiter(map(len, words), np.int64, len(words))
        code, after, levels = self._nodes(*words)
        n = len(code) - 1
        found, at, to, first, bare = [], np.arange(1, n + 1), after[1:], True, np.ones(n + 1, bool)
        state = model.root[code[1:]]
        while True:
            some = np.flatnonzero(state >= 0)
            at, to, state = at[some], to[some], state[some]
            piece = model.piece_at[state]
            hit = np.flatnonzero(piece >= 0)
            if first:  # a character without a piece: its bytes, as one id above all pieces
                bare[at[hit]] = bare[0] = first = False
                none = np.flatnonzero(bare)
                found.append((none, len(model.pieces) + code[none], after[none]))
            found.append((at[hit], piece[hit], to[hit]))
            more = np.flatnonzero(to)
            at, to, state = at[more], to[more], state[more]
            if not len(at):
                break
            state, to = model.follow(state, code[to]), after[to]
        degree = np.zeros(n + 1, np.int64)
        for at, _, _ in found:
            degree[at] += 1
        first = np.concatenate([[0], np.cumsum(degree)])
        self.ids, self.to = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
        free = first[:-1].copy()
        for at, piece, to in reversed(found):  # the longest, mostly the likeliest, comes first
            slot = free[at]
            free[at] += 1
            self.ids[slot], self.to[slot] = piece, to
        known = len(model.pieces)
        score = model.scores[np.minimum(self.ids, known - 1)]
        odd = np.flatnonzero(self.ids >= known)
        score[odd] = utf8_size(self.ids[odd] - known) * model.byte_score
        rest, low = np.zeros(n + 1), 1
        self.log, self.cum = np.empty(first[-1]), np.empty(first[-1])
        for m in levels:
            high = low + m
            a, b, each = first[low], first[high], degree[low:high]
            starts, to = first[low:high] - a, self.to[a:b]
            w = score[a:b] + rest[to]
            top = np.maximum.reduceat(w, starts)
            part = np.exp(w - np.repeat(top, each))
            total = np.add.reduceat(part, starts)
            rest[low:high] = top + np.log(total)
            self.log[a:b] = w - np.repeat(rest[low:high], each)
            self.cum[a:b] = part / np.repeat(total, each)
            low = high
        # sums of a place's own edges alone, so that no rounding comes from its neighbours
        for low in range(0, n + 1, 1 << 16):
            a, b, many = first[low:low + (1 << 16)], first[low + 1:low + 1 + (1 << 16)], degree[low:low + (1 << 16)] > 1
            at, stop = a[:len(many)][many], b[many]
            while len(at):
                at = at + 1
                self.cum[at] += self.cum[at - 1]
                more = at + 1 < stop
                at, stop = at[more], stop[more]
        self.cum[first[2:] - 1] = 2.0  # the last edge takes what rounding leaves
        self.first, self.node = first, np.repeat(np.arange(n + 1, dtype=np.int32), degree)
        # for draws: the first edge of the place after each edge, -1 at the end; bounds of 53 random bits
        self.next = np.where(self.to, first[self.to], -1).astype(np.int32)
        self.bound = np.ceil(self.cum * 2.0 ** 53).astype(np.int64)

    def _nodes(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Each node's character and the node after it, and how many nodes each distance from the end has."""
        end = np.cumsum(size)
        self.start, live, low = np.zeros(len(size), np.int64), np.arange(len(size)), 1
        code, after, levels = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], []
        for m in range(1, SHARED + 1):
            if not len(live):
                break
            kinds, which = np.unique(self.start[live] << 21 | codes[end[live] - m], return_inverse=True)
            self.start[live] = low + which
            code.append(kinds & (1 << 21) - 1)
            after.append(kinds >> 21)
            levels.append(len(kinds))
            low += len(kinds)
            live = live[size[live] > m]
        if len(live):  # the places before the last characters of long words, each for itself
            long = size[live] - SHARED
            begin = np.cumsum(long + 1) - long - 1  # each word's places and the node after them
            node = np.empty(int(long.sum()) + len(live), np.int64)
            node[begin + long] = self.start[live]
            of, nth = spread(long)
            left = long[of] - nth
            order = np.argsort(left, kind="stable")
            at = begin[of[order]] + nth[order]
            node[at] = low + np.arange(len(at))
            code.append(codes[(end - size)[live][of[order]] + nth[order]])
            after.append(node[at + 1])
            levels += np.bincount(left)[1:].tolist()
            self.start[live] = node[begin]
        return np.concatenate(code), np.concatenate(after), levels

    def choose(self, e: np.ndarray, x: np.ndarray) -> np.ndarray:
        """An edge of each place, given by its first, by its conditional probability, from 64 random bits."""
        x = (x >> np.uint64(11)).view(np.int64)
        more = np.flatnonzero(x >= self.bound.take(e))
        if not len(more):
            return e
        e, x, at = e.copy(), x[more], e[more]
        while len(more):
            at += 1
            e[more] = at
            still = np.flatnonzero(x >= self.bound.take(at))
            more, x, at = more[still], x[still], at[still]
        return e

    def draw(self, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A random way from each place, given by its first edge, to its word's end: (edges of all, in order; how many each)."""
        live, count = None, np.ones(len(place), np.int64)
        made, x = [], seed
        while len(place):
            e = self.choose(place, x)
            made.append((live, e))
            place = self.next.take(e)
            on = np.flatnonzero(place >= 0)
            live, place, seed = on if live is None else live[on], place[on].astype(np.int64), seed[on]
            count[live] = len(made) + 1
            x = mix(seed + step(len(made)))
        begin = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for i, (live, e) in enumerate(made):
            edges[begin if live is None else begin[live] + i] = e
        return edges, count


def step(n: int) -> np.uint64:
    """The ``n``-th step of a SplitMix64 sequence."""
    return np.uint64(n * int(GOLDEN) & (1 << 64) - 1)


def utf8_size(code: np.ndarray) -> np.ndarray:
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


def spell(model: Lattice, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with the characters that have no piece as their bytes, and how many each became."""
    count = np.ones(len(ids), np.int64)
    odd = np.flatnonzero(ids >= len(model.pieces))
    if not len(odd):
        return ids, count
    codes, which = np.unique(ids[odd] - len(model.pieces), return_inverse=True)
    count[odd] = utf8_size(codes)[which]
    out, place = np.repeat(ids, count), np.cumsum(count) - count
    table = np.zeros((len(codes), 4), np.int64)
    for i, c in enumerate(codes.tolist()):
        raw = list(chr(c).encode())
        table[i, :len(raw)] = model.byte_ids[raw]
    for j in range(4):
        some = count[odd] > j
        out[place[odd[some]] + j] = table[which[some], j]
    return out, count


def spread(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, number within it) of each member of groups of these sizes."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)


class Search:
    """The perturbed A-star search of many texts, one expanded prefix of each at a time.

    Open prefixes and finished paths share a table of k + 1 rows for each text;
    only the greatest scores stay in it. A row says where its prefix leaves the
    path of an earlier round, and by which edge.
    """

    def __init__(self, chains: Chains, words: list[np.ndarray], k: int, seeds: np.ndarray):
        self.chains, self.seeds = chains, seeds
        size = np.array([len(w) for w in words], np.int64)
        self.end = np.cumsum(size)
        self.starts = chains.first[chains.start[np.concatenate(words)]]  # the first edge of every word
        shape = (len(words), k + 1)
        self.score, self.done = np.full(shape, -np.inf), np.zeros(shape, bool)
        self.phi, self.word, self.edge = np.zeros(shape), np.zeros(shape, np.int64), np.full(shape, -1, np.int64)
        self.of, self.cut = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.score[:, 0] = -np.log(exponential(mix(seeds)))
        self.word[:, 0] = self.end - size - 1  # before the first
        self.paths: list[list[np.ndarray]] = [[] for _ in words]

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the best open prefix of each text; -inf where there is none."""
        score = np.where(self.done, -np.inf, self.score)
        row = np.argmax(score, axis=1)
        return row, score[np.arange(len(row)), row]

    def keep(self, t, score, phi, word, edge, cut, round_: int) -> None:
        """Put prefixes into their texts' tables, the best first, each in the place of the least row."""
        order = np.lexsort((-score, t))
        place = np.arange(len(order)) - np.searchsorted(t[order], t[order], "left")
        for j in range(min(int(place.max(initial=-1)) + 1, self.score.shape[1])):
            o = order[place == j]
            row = np.argmin(self.score[t[o]], axis=1)
            over = score[o] > self.score[t[o], row]
            o, row = o[over], row[over]
            at = (t[o], row)
            self.score[at], self.phi[at], self.word[at], self.edge[at] = score[o], phi[o], word[o], edge[o]
            self.of[at], self.cut[at], self.done[at] = round_, cut[o], False

    def round(self, number: int) -> list[tuple[int, float, float]]:
        """Expand the best open prefix of each text to its end: [(text, log-probability, perturbed score)...]."""
        chains = self.chains
        row, g = self.best()
        t = np.flatnonzero(g > -np.inf)
        at, g = (t, row[t]), g[t]
        self.done[at] = True
        phi, edge, seed = self.phi[at], self.edge[at], mix(self.seeds[t] + step(number + 1))
        length = np.where(edge >= 0, self.cut[at] + 1, 0)  # of the prefix, its own edge included
        # the rest of the word begun, if any, and the words after it
        node = np.where(edge >= 0, chains.next[edge], -1)
        first = self.word[at] + (node < 0)
        size = self.end[t] - first
        stop = np.cumsum(size)
        start = stop - size
        nth = np.arange(int(size.sum()))  # of all texts, one after another
        words = np.repeat(first - start, size) + nth
        places = self.starts.take(words)
        begun = np.flatnonzero((node >= 0) & (size > 0))
        places[start[begun]] = node[begun]
        bits = np.repeat(seed + (length + 1 - start).astype(np.uint64) * GOLDEN, size) + nth.astype(np.uint64) * GOLDEN
        edges, count = chains.draw(places, mix(bits))
        ends = np.cumsum(count)
        many = np.concatenate([[0], ends])
        size = many[stop] - many[start]
        start = np.cumsum(size) - size
        step_ = chains.log.take(edges)
        run = np.empty(len(step_) + 1)
        for a, b in zip(start.tolist(), (start + size).tolist()):  # each text alone: no rounding from its neighbours
            np.add.accumulate(step_[a:b], out=run[a + 1:b + 1])
        total = np.where(size > 0, run[start + size], 0.0)
        run[start] = 0.0
        before = np.repeat(phi, size) + run[:-1]  # log-probability of the prefix at each place
        self._others(t, g, seed, number, start, size, edges, before, length,
                     lambda x: words[np.searchsorted(ends, x, "right")])
        ids = chains.ids[edges]
        for i, e, a, b, m, r in zip(t.tolist(), edge.tolist(), start.tolist(), (start + size).tolist(), length.tolist(),
                                    self.of[at].tolist()):
            head = [self.paths[i][r][:m - 1], chains.ids[e:e + 1]] if e >= 0 else []
            self.paths[i].append(np.concatenate([*head, ids[a:b]]))
        phi = phi + total
        return list(zip(t.tolist(), phi.tolist(), g.tolist()))

    def _others(self, t, g, seed, number, start, size, edges, before, length, word_of) -> None:
        """Score the children that the paths pass by, nearest to the start first, and keep the best."""
        low, high = 0, 8
        of, place = spread(np.minimum(size, high))
        some = start[of] + place
        while True:
            for a in range(0, len(some), CHILDREN):
                part = slice(a, a + CHILDREN)
                self._score(some[part], of[part], place[part], t, g, seed, number, edges, before, length, word_of)
            floor = self.score[t].min(axis=1)  # has risen with what was kept
            if low == 0:
                left = np.flatnonzero(before >= np.repeat(floor - RARE, size))
                left_of = np.searchsorted(start + size, left, "right")
            else:
                some = np.flatnonzero(before[left] >= floor[left_of] - RARE)
                left, left_of = left[some], left_of[some]
            some = np.flatnonzero(left - start[left_of] >= high)
            left, left_of = left[some], left_of[some]
            if not len(left):
                break
            low, high = high, 8 * high
            place = left - start[left_of]
            some = np.flatnonzero(place < high)
            of, place, some = left_of[some], place[some], left[some]

    def _score(self, x, i, place, t, g, seed, number, edges, before, length, word_of) -> None:
        """Scores as arrival times: that of a child is -log(exp(-g) + time), its time exponential with its mass as rate.

        So the earliest of all others of a place needs one number, and only where
        that one is early enough do the children get theirs: one of them, by its
        mass, has the earliest time, and the rest come after it, each by its own
        exponential.
        """
        chains, floor = self.chains, self.score[t].min(axis=1)
        place = place + length[i]
        bits = mix(~seed[i] + (place + 1).astype(np.uint64) * GOLDEN)
        # an exponential -log(u) is 1 - u at least; most show by that alone that they come too late
        with np.errstate(over="ignore"):
            soon = np.flatnonzero(1.0 - uniform(bits) <= np.exp(before[x] - floor[i]) * (1 + 1e-6))
        x, i, place, bits = x[soon], i[soon], place[soon], bits[soon]
        chosen = chains.log[edges[x]]
        with np.errstate(divide="ignore"):
            time = np.log(exponential(bits)) - before[x] - np.log(-np.expm1(chosen))  # logarithms of times
        node = chains.node[edges[x]]
        first, many = chains.first[node], chains.first[node + 1] - chains.first[node]
        early = np.flatnonzero((-np.logaddexp(-g[i], time) > floor[i]) & (many > 1))
        if not len(early):
            return
        x, i, place, time, bits, first, many = (v[early] for v in (x, i, place, time, bits, first, many))
        y, nth = spread(many)
        other = first[y] + nth
        bits = mix(bits[y] + (nth + 1).astype(np.uint64) * GOLDEN)
        own = np.where(other == edges[x][y], np.inf, np.log(exponential(bits)) - chains.log[other])
        # the least of fresh exponentials belongs to a child by its mass; the rest are fresh after that time
        least = np.minimum.reduceat(own, np.cumsum(many) - many)
        is_first = own == least[y]
        after = np.log(exponential(mix(bits))) - before[x][y] - chains.log[other]
        time = np.where(is_first, time[y], np.logaddexp(time[y], after))
        i = i[y]
        found = -np.logaddexp(-g[i], time)
        new = np.flatnonzero((found > floor[i]) & (other != edges[x][y]))
        x, i, place = x[y][new], i[new], place[y][new]
        self.keep(t[i], found[new], (before[x] + chains.log[other[new]]), word_of(x), other[new], place, number)


def chunked(texts: list[str]) -> tuple[list[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The words of each escaped text as numbers, and the different words as ``Chains`` takes them: they begin where spaces begin."""
    raw = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
    blob, size = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
    space = np.frombuffer(blob, np.uint8) == 32
    begin = np.cumsum(size) - size
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[begin[size > 0]] = True
    at = np.flatnonzero(first)
    offsets = np.append(at, len(blob)).astype(np.int32)
    coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(blob)).dictionary_encode()
    number = np.asarray(coded.indices).astype(np.int64)
    cuts = np.searchsorted(at, np.append(begin, len(blob))).tolist()
    return [number[a:b] for a, b in zip(cuts, cuts[1:])], code_points(coded.dictionary)


def code_points(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The escaped code points of all ``words``, and how many each has."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1)
    raw = np.frombuffer(words.buffers()[2], np.uint8, ends[-1])
    many = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters before each byte
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    codes[codes == 32] = ord(SPACE)
    return codes, np.diff(many[ends])


def uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 of 64 random bits each."""
    return ((bits >> np.uint64(11)) + 0.5) * 2.0 ** -53


def exponential(bits: np.ndarray) -> np.ndarray:
    """Exponential numbers of 64 random bits each."""
    return -np.log(uniform(bits))


def sample_many(model: Lattice, texts: list[str], k: int,
                seeds: list[int]) -> list[list[tuple[np.ndarray, float, float, float, bool]]]:
    """``sample`` of every text, with whether the ids decode to it."""
    words, kinds = chunked(texts)
    some = [i for i, w in enumerate(words) if len(w)]
    out: list = [[(np.zeros(0, np.int32), 0.0, 0.0, 1.0, True)][:k] for _ in texts]
    if not some:
        return out
    chains, part, n = Chains(model, kinds), [], 0
    for i in some:
        part.append(i)
        n += len(words[i])
        if n >= GROUP_WORDS or i == some[-1]:
            made = _sample_group(model, chains, [words[j] for j in part], [texts[j] for j in part], k, [seeds[j] for j in part])
            for j, x in zip(part, made):
                out[j] = x
            part, n = [], 0
    return out


def _sample_group(model: Lattice, chains: Chains, words: list[np.ndarray], texts: list[str], k: int, seeds: list[int]):
    """``sample_many`` of texts that have words, by the chains of their words."""
    search = Search(chains, words, k, np.array(seeds, np.uint64))
    found = [[] for _ in texts]
    for r in range(k):
        for i, phi, g in search.round(r):
            found[i].append((phi, g))
    missed = search.best()[1].tolist()
    flat = [ids for paths in search.paths for ids in paths]
    ids, count = spell(model, np.concatenate(flat))
    ids = ids.astype(np.int32, copy=False)
    ends = np.cumsum(count)[np.cumsum(list(map(len, flat))) - 1].tolist()
    raw = model.binary.take(pa.array(ids))
    place = np.frombuffer(raw.buffers()[1], np.int32, len(ids) + 1)
    raw, a, ends = raw.buffers()[2], 0, iter(ends)
    for text, made, miss in zip(texts, found, missed):
        out, wanted = [], None if SPACE in text else escape(text).encode()
        for phi, g in made:
            b = next(ends)
            ok = (decode(ids[a:b].tolist(), model.pieces) == text if wanted is None
                  else raw[int(place[a]):int(place[b])].to_pybytes() == wanted)
            chance = 1.0 if miss == -math.inf else -math.expm1(-math.exp(min(700.0, phi - miss)))
            out.append((ids[a:b], phi, g, chance, ok))
            a = b
        yield out


_LATTICES: dict = {}


def lattice(path: str | None, alpha: float) -> Lattice:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    if (path, alpha) not in _LATTICES:
        _LATTICES[path, alpha] = Lattice(path, alpha)
    return _LATTICES[path, alpha]


def sample_rows(rows: DataFrame, samples: int = 4, alpha: float = 1.0, model: str | None = None,
                keys: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(keys..., sample, ids, log_probability, perturbed, inclusion, decoded) of each row of ``rows``.

    Samples are numbered from 1 by falling perturbed score; a text with fewer
    segmentations has fewer. The seed is the hash of the keys, so a result does
    not depend on partitions, and rows that repeat their keys draw alike. Null
    or empty texts have one segmentation, without pieces. ``decoded`` tells that
    the ids decode to the text. An empty table gives an empty result.
    """
    def draw(batch: pa.RecordBatch) -> pa.RecordBatch:
        seeds = [xxhash.xxh64_intdigest(repr(key).encode())
                 for key in zip(*(batch.column(f"k{i}").to_pylist() for i in range(len(keys))))]
        found = sample_many(lattice(model, alpha), batch.column("text").to_pylist(), samples, seeds)
        of = [row for row, made in enumerate(found) for _ in made]
        number = [j for made in found for j in range(1, len(made) + 1)]
        ids, phi, g, chance, decoded = zip(*(x for made in found for x in made))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        made = [pa.array(number, pa.int32()), ids, *(pa.array(c, pa.float64()) for c in (phi, g, chance)),
                pa.array(decoded, pa.bool_())]
        return pa.record_batch([batch.column(f"k{i}").take(pa.array(of)) for i in range(len(keys))] + made,
                               [*keys, "sample", "ids", "log_probability", "perturbed", "inclusion", "decoded"])

    types = dict(rows.dtypes)
    chosen = rows.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)],
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in keys], "sample int, ids array<int>, log_probability double, "
                        "perturbed double, inclusion double, decoded boolean"])
    return arrow_map(chosen, draw, schema, limit=SLICE_BYTES)
