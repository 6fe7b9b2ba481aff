"""Every operator against brute force on small tables with awkward rows."""

import base64
import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
import zstandard

from ledgerguard.llm import gumbel_pieces, html_gbt, packing, pfp_dedup, quality_bayes, quality_rules, sharding
from ledgerguard.llm import simhash_gray, sketches
from ledgerguard.llm.common import STEP_BYTES, components, numbered, steps
from ledgerguard.llm.line_dedup import dedup_lines
from ledgerguard.llm.queries import LLM_ORACLE, LLM_QUERIES

# extra columns bear the names that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, r string, gone int, fp int, shard int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward():
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(200)]

    def say(n):
        return " ".join(rnd.choice(words) for _ in range(n))
    base = [say(150) for _ in range(6)]
    texts = [None, "", "x", " \t\r\n ", "a" * 900, "ab " * 400, base[0], base[0], base[0] + " more words at the end",
             "\n".join([base[1], "A shared line here", base[2]]), "  a SHARED line here\n" + base[3], base[4][:500],
             "\n".join(say(9) for _ in range(40)), say(6000), "éü€😀 " * 30, " nbsp wide " * 8, base[1]]
    texts += [base[i % 6][rnd.randint(0, 300):] + " " + say(rnd.randint(0, 60)) for i in range(20)]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}", len(t or ""), 1, "r", 2, 3, 4) for i, t in enumerate(awkward())]
    rows += [rows[6], (None, "a text without an id, of some twenty words or more " * 3, None, None, None, 1, "r", 2, 3, 4)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("awkward"))
    docs.write.parquet(f"{folder}/documents.parquet")
    html = [None, "", "plain", "<p>unclosed <b>x<br><p>y", "<article><h1>T &amp; U</h1><p>a\n  b</article><script>var a='</p>'"]
    spark.createDataFrame([(i, f"http://h/{i}", h, 1) for i, h in enumerate(html)], "page_id long, url string, html string, text int"
                          ).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(i, int(i > 5), 0, 1) for i in range(30)] + [(None, 1, 0, 1)], "doc_id long, quality int, toxic int, k int"
                          ).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, 0, "user", None, 1), (0, 1, "bot", "", 1), (1, 0, "user", "I am  here\n", 1), (None, None, None, "ü😀 x", 1)],
                          "conv_id long, turn long, role string, text string, k0 int").write.parquet(f"{folder}/conversations.parquet")
    return folder


#: Those that read other tables have tests of their own in ``test_search_codes``.
TABLES = [n for n in LLM_QUERIES if not n.startswith(("op11_", "op12_", "op13_"))]


@pytest.mark.parametrize("name", TABLES)
def test_awkward_and_empty_tables(spark, sf_dir, tmp_path, name):
    rows = LLM_QUERIES[name](spark, sf_dir).collect()
    assert rows
    for t in ("documents", "pages", "labels", "conversations"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert LLM_QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", [n for n in LLM_ORACLE if n in TABLES])
def test_oracle_on_awkward_rows(spark, sf_dir, name):
    con = duckdb.connect()
    # the line oracle keys by doc_id: repeated and null ids have their own rules
    con.sql(f"create view documents as select distinct * from '{sf_dir}/documents.parquet/*.parquet' where doc_id is not null")
    want = con.sql(LLM_ORACLE[name]).df()
    folder = f"{sf_dir}/distinct-{name}"
    spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id is not null").distinct().write.parquet(f"{folder}/documents.parquet")
    got = LLM_QUERIES[name](spark, folder).toPandas()[list(want.columns)]
    key = list(want.columns)
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, want[key].values.tolist()))


def test_line_dedup_null_and_repeated_ids(spark):
    rows = [(2, "a line of text\nown"), (1, "A LINE of text \n"), (1, "a line of text"), (None, "a line of text\nlast"), (3, None)]
    got = collections.Counter((r.k if r.k < 10 else None, r.n_lines, r.n_dropped, r.kept) for r in
                              dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=3).collect())
    assert got == collections.Counter([(2, 2, 1, "own"), (1, 2, 0, "A LINE of text \n"), (1, 1, 0, "a line of text"),
                                       (None, 2, 1, "last"), (3, 1, 0, "")])


def test_quality_base_measures():
    for text in awkward():
        text = text or ""
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        again = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i:i + 8])] > 1:
                again |= set(range(i, i + 8))
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again))
        assert quality_rules.base_measures(text.encode()) == want


def test_quality_bands_reject_repetition_and_noise():
    packer = quality_rules.zstandard.ZstdCompressor(level=3)
    rnd = random.Random(1)
    noise = "".join(chr(rnd.randint(33, 126)) for _ in range(5000)).encode()
    loop = b"the same few words again " * 200
    prose = " ".join("".join(rnd.choice("aeinorst") for _ in range(rnd.randint(1, 9))) for _ in range(900)).encode()
    verdict = [quality_rules.band_verdict(t, quality_rules.Bands(), packer)[3] for t in (noise, loop, prose, prose + loop)]
    assert verdict == [False, False, True, False]  # the last by its chunks


def noise_and_prose():
    rnd = random.Random(5)
    noise = "".join(" " if rnd.random() < 0.1 else chr(rnd.randint(33, 126)) for _ in range(5000)).encode()
    prose = " ".join("".join(rnd.choice("aeinorst") for _ in range(rnd.randint(1, 9))) for _ in range(3000)).encode()
    return noise, prose


def test_quality_chunks_cover_the_end_and_short_texts():
    packer = quality_rules.zstandard.ZstdCompressor(level=3)
    noise, prose = noise_and_prose()

    def kept(*parts):
        return quality_rules.band_verdict(b"".join(parts), quality_rules.Bands(), packer)[3]
    assert all(kept(prose[:n]) for n in (300, 511, 512, 700, 1024, 2047, 2048, 2049, 4000, 6144, 10_000))
    assert not kept(prose[:2048], noise[:2000])
    assert not kept(prose[:4096], noise[:2040])
    assert not kept(prose[:900], noise[:1023])  # no chunk of 2048 bytes
    assert not kept(prose[:5000], noise[:1023], prose[:5000])
    for n in (512, 1300, 2048, 5000):  # every byte lies in a chunk
        sizes = [size for size, _, _ in quality_rules.Bands().chunks if size <= n]
        seen = []

        class Packer:
            def compress(self, part):
                seen.append(len(part))
                return b"x" * (len(part) // 2)
        quality_rules.band_verdict(prose[:n], quality_rules.Bands(), Packer())
        assert seen[1:] == [size for size in sizes for _ in range(-(-n // size))]


def test_quality_limits_reject_base64_and_noise_of_each_length():
    packer, rnd = quality_rules.zstandard.ZstdCompressor(level=3), random.Random(6)
    noise, prose = noise_and_prose()
    coded = base64.encodebytes(rnd.randbytes(60_000))

    def kept(*parts):
        return quality_rules.band_verdict(b"".join(parts), quality_rules.Bands(), packer)[3]
    for n in (200, 256, 400, 512, 600, 700, 800, 1000, 1024, 1500, 2048, 3000, 4000, 5000, 16_000, 70_000):
        assert not kept(coded[:n]), n
    for n in (200, 256, 400, 512, 600, 700, 800, 1000, 1024, 1500, 2048, 3000, 4000, 5000):
        assert not kept(noise[:n]), n
    assert not kept(prose[:4096], coded[:4096], prose[:2048])
    # prose of other scripts stays
    draw = np.random.default_rng(2)
    for first, step, n, word in ((0x430, 1, 32, 9), (0x3b1, 1, 25, 9), (0x905, 1, 60, 8), (0xac00, 8, 1300, 5), (0x4e00, 6, 3000, 4)):
        p = 1 / (np.arange(n) + 12.0)
        text = " ".join("".join(chr(first + step * int(i)) for i in draw.choice(n, draw.integers(1, word), p=p / p.sum()))
                        for _ in range(4000))
        for size in (256, 1200, 2100, 5000, 20_000):
            assert kept(text.encode()[:size].decode("utf-8", "ignore").encode()), (hex(first), size)


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_xxh64_seed(spark):
    from pyspark.sql import functions as F
    for text in awkward():
        assert simhash_gray.fingerprint((text or "").encode()) == brute_fingerprint(text)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("bucket_rows", [200_000, 5])
def test_gray_index_links_equal_brute_force(spark, bucket_rows):
    rnd = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for _ in range(rnd.randint(1, 4)):
                x ^= 1 << rnd.randrange(64)
    fps = sorted(fps)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash_gray.fingerprint_links(frame, 3, bucket_rows=bucket_rows)
    got = {r.node % (1 << 64): r.component for r in components(edges).collect()}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= 3:
                parent[find(a)] = find(b)
    groups = collections.defaultdict(set)
    for f in fps:
        groups[got.get(f, ("alone", f))].add(f)
    want = collections.defaultdict(set)
    for f in fps:
        want[find(f)].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_chains(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def brute_repeats(texts, length):
    count = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        flag = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                flag[i:i + length] = b"\1" * length
        kept = bytes(x for x, f in zip(t, flag) if not f)
        out.append((len(t), sum(flag), len([x for x in bytes(flag).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,width,bucket_rows", [(100, 16, 50_000), (100, 16, 2), (400, 64, 50_000)])
def test_suffix_array_dedup(spark, docs, length, width, bucket_rows):
    rows = docs.select("doc_id", "text").collect()
    want = brute_repeats([(r.text or "").encode() for r in rows], length)
    got = pfp_dedup.drop_repeats(docs, length=length, width=width, bucket_rows=bucket_rows, digest=True).collect()
    ids = [r.doc_id if r.doc_id is not None else pfp_dedup.keyed.__globals__["NULL_ID"] for r in rows]
    assert collections.Counter((r.k, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == collections.Counter(
        (i, *w) for i, w in zip(ids, want))


@pytest.mark.parametrize("bucket_rows", [50_000, 2])
def test_long_runs(spark, bucket_rows):
    texts = [say + fill * (n // len(fill)) + end for say, end in (("", ""), ("some words ", " and more"), ("x" * 30, "yz"))
             for fill in (" ", "-+", "lorem ipsum ", "a phrase of words, " * 9 + "once ") for n in (300, 3000, 5000)]
    texts += ["é" * 1500 + t for t in texts[::5]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pfp_dedup.drop_repeats(rows, length=100, width=16, bucket_rows=bucket_rows, digest=True).collect()
    assert sorted((r.k, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [
        (i, *w) for i, w in enumerate(brute_repeats([t.encode() for t in texts], 100))]


def test_a_run_is_few_rows(spark):
    texts = [b"head " + fill * ((3 << 20) // len(fill)) + b" tail" for fill in (b" ", b"-+", b"lorem ipsum ")]
    rows = spark.createDataFrame([(bytes([i]) * 16, t) for i, t in enumerate(texts)], "r binary, text binary")
    got = collections.defaultdict(list)
    for x in pfp_dedup.phrase_rows(rows, 400, 64).collect():
        got[x.r[0]].append((x.start, x.times * x.n))
    for i, text in enumerate(texts):  # every window is in one row, and the rows are few
        assert len(got[i]) < 1500 and sum(n for _, n in got[i]) == len(text) - 399
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(got[i]), sorted(got[i])[1:]))


def test_steps_hold_few_texts_that_pack_well(spark):
    rows = spark.range(64).selectExpr("unhex(lpad(hex(id), 32, '0')) r", "cast(repeat('some words ', 100000) as binary) text")
    batches = pfp_dedup._packed(rows).coalesce(1).toArrow().combine_chunks().to_batches()
    unpack = zstandard.ZstdDecompressor()
    held = [sum(len(unpack.decompress(x)) for x in step.column("packed").to_pylist())
            for step in steps(batches, "n_bytes")]
    assert sum(held) == 64 * 1_100_000 and max(held) <= STEP_BYTES + 1_100_000


def test_parse_is_the_same_in_every_context():
    rnd = random.Random(5)
    common = bytes(rnd.choice(b"abcd ") for _ in range(900))
    a, b = (bytes(rnd.choice(b"abcd ") for _ in range(n)) + common for n in (777, 50))
    marks = []
    for text in (a, b):
        shift = len(text) - len(common)
        found = {}
        for core, start, n, offset in zip(*pfp_dedup.parse(text)):
            for i in range(int(n)):
                found[int(start) + i - shift] = int(offset) - i
        marks.append({p: o for p, o in found.items() if p >= 0})
    assert marks[0] == marks[1] and len(marks[0]) == 501


def test_tokens_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    encode = packing.encoder(path)
    for text in [t or "" for t in awkward()] + ["It's 2024, we'll DON'T!! 'Tis ÀÉ ß÷×", "<|endoftext|> x", "é ﬁ İ"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 60), (2, 3000), (3, 40_000)])
def test_packing_plan(seed, n):
    rnd = np.random.default_rng(seed)
    lengths = np.clip(rnd.lognormal(6.3, 1.0, n).astype(int), 1, 2048)
    histogram = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    made = collections.Counter()
    sequences = 0
    for content, number in packing.plan(histogram):
        assert sum(x * each for x, each in content) <= 2048
        sequences += number
        for x, each in content:
            made[x] += each * number
    assert made == histogram
    assert sequences <= 1.005 * -(-int(lengths.sum()) // 2048) + 1


def test_packed_sequences_are_gapless(spark, docs):
    rows = packing.pack(docs).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert min(r.length for r in rows) == 1  # a null text is the closing id


def test_numbered_has_no_gaps(spark):
    rows = spark.range(1000).selectExpr("id % 3 as g", "id % 7 as a", "id as b")
    got = collections.defaultdict(list)
    for r in numbered(rows, "g", ["b", "a"], "n", block=10).collect():
        got[r.g].append((r.n, r.b))
    for x in got.values():
        assert [n for n, _ in sorted(x)] == list(range(len(x))) and [b for _, b in sorted(x)] == sorted(b for _, b in x)


def test_sharding_law_and_weights(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "'x' as text")
    got = sharding.shard_documents(rows).collect()
    assert all(r.grown_shard in (r.shard, 24) for r in got)
    moved = sum(r.grown_shard == 24 for r in got)
    assert 600 < moved < 1000  # a 25th of the rows
    assert all(640 < n < 1030 for n in collections.Counter(r.shard for r in got).values())
    # a weight that changes moves rows into or out of its own region alone
    keys = rows.selectExpr("cast(doc_id as string) as key")
    tree = sharding.tree(24)
    heavier = {g: {r: dict(s) for r, s in x.items()} for g, x in tree.items()}
    heavier["g1"]["r2"][20] = 3.0
    both = sharding.assign(sharding.assign(keys, "key", tree, "a"), "key", heavier, "b").where("a <> b").collect()
    assert both and all(r.b >= 12 for r in both)


def test_sketches_estimate_and_merge(spark):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10 ** 9)}" for _ in range(4000)]
    a, b = " ".join(words[:3000]).encode(), " ".join(words[1000:]).encode()
    x, y = sketches.sketch(a), sketches.sketch(b)
    assert abs(sketches.resemblance(x, y) - 0.5) < 0.15
    assert abs(sketches.containment(x, y) - 2 / 3) < 0.2
    assert abs(sketches.distinct(x) / 2996 - 1) < 0.3
    assert np.array_equal(sketches.decode(sketches.encode(x)), x)
    rows = spark.createDataFrame([(1, a.decode(), "g"), (2, b.decode(), "g"), (3, "", "h")], "doc_id long, text string, p string")
    merged = {r.p: r.fingerprint for r in sketches.merged_sketches(sketches.document_sketches(rows, "p"), "p").collect()}
    assert merged == {"g": sketches.encode(sketches.merge(x, y))}


def test_edited_texts(spark):
    texts = [t or "" for t in awkward()] * 3
    rows = spark.createDataFrame([(3 * i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    follow = texts[1:] + texts[:1]
    whole = sketches.in_order(sketches.keyed(rows), rows=10)
    assert whole.where("ghost = 0").count() == len(texts) and whole.select("part").distinct().count() > 5
    got = {r.doc_id: r for r in sketches.edited_fingerprints(rows).collect()}
    for i, (t, n) in enumerate(zip(texts, follow)):
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        r = got[3 * i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        own, new, after = brute_shingles(t), brute_shingles(edited), brute_shingles(n)
        assert sketches.decode(r.fingerprint).tolist() == sorted(own)[:128]
        assert sketches.decode(r.edited_fingerprint).tolist() == sorted(new)[:128]
        for got_, a, b in ((r.near_edited, own, new), (r.near_next, own, after)):
            least = sorted(a | b)[:128]
            assert abs(got_ - (sum(h in a and h in b for h in least) / len(least) if least else 1.0)) < 1e-12


def brute_shingles(text):
    """All hashes of five-word shingles."""
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(text)]
    return {xxhash.xxh64_intdigest(" ".join(w[i:i + 5]).encode()) for i in range(max(1, len(w) - 4))} if w else set()


def test_html_held_out_accuracy_and_consistent_verdicts():
    model, good, all_text = html_gbt.trained(), 0, 0
    for seed in range(50_000, 50_080):
        page = html_gbt.Page(html_gbt._Writer(seed).page())
        x, own, total = html_gbt.features(page)
        verdict = html_gbt.decode(page, model.probability(x), own, total)
        truth = np.array([m == "1" for m in page.marks])
        good, all_text = good + own[verdict == truth].sum(), all_text + own.sum()
    assert good / all_text > 0.98


def test_html_extraction(spark):
    html = ("<html><body><nav><ul><li><a href='/x'>Home</a></li></ul></nav><div class='ad'>Buy now</div><article><h1>A &lt;title&gt;"
            "</h1><p>First  line\nof text, with words and more words.</p><p>Second&nbsp;one, which is long enough to read.</article>"
            "<section class='comments'><p>Nice!</p></section><footer>&copy; me</footer>")
    rows = spark.createDataFrame([(1, "u", html), (2, "u", None)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_gbt.extract(rows).collect()}
    assert got == {1: "A <title>\nFirst line of text, with words and more words.\nSecond one, which is long enough to read.", 2: ""}


NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
TWO = ("<p>This is a first paragraph of the article, with enough words to be read as one.</p>"
       "<p>And here is the second one, which goes on a little longer than that, with commas, and ends.</p>")
SAID = ["This is a first paragraph of the article, with enough words to be read as one.",
        "And here is the second one, which goes on a little longer than that, with commas, and ends."]
PAGES = {
    "short": (f"<html><body>{NAV}<article><p>Short.</p></article></body></html>", ["Short."]),
    "short last": (f"<html><body>{NAV}<article><h1>Title here</h1>{TWO}<p>Short end.</p></article><footer>&copy; x</footer></body></html>",
                   ["Title here", *SAID, "Short end."]),
    "references": (f"<html><body>{NAV}<article><h1>Title here</h1>{TWO}<p>A &amp; B &lt;c&gt; &eacute;.</p></article></body></html>",
                   ["Title here", *SAID, "A & B <c> é."]),
    "links": (f"<html><body>{NAV}<article><h1>Weekly reading</h1><p><a href=1>The first story that we read</a> and <a href=2>the second one, "
              "which was much longer</a>, then <a href=3>a third</a>.</p><p><a href=4>Another sentence that is a link as a whole.</a></p>"
              "</article><footer>&copy; x</footer></body></html>",
              ["Weekly reading", "The first story that we read and the second one, which was much longer, then a third.",
               "Another sentence that is a link as a whole."]),
    "figure, no page": (f"<article>{TWO}<figure><img src=x></figure><p>After the figure there is another paragraph, of some words.</p></article>",
                        [*SAID, "After the figure there is another paragraph, of some words."]),
    "unsegmented": ("<html><body><div class=menu><ul><li><a href=/>首页</a></li><li><a href=/n>新闻</a></li><li><a href=/t>体育</a></li></ul></div>"
                    "<article><h1>标题在这里</h1><p>这是文章的第一段，内容很长，讲述了一个故事，关于一个人和他的城市。</p>"
                    "<p>第二段继续讲述这个故事，有更多的细节，也有更多的人物。</p></article><footer>版权所有</footer></body></html>",
                    ["标题在这里", "这是文章的第一段，内容很长，讲述了一个故事，关于一个人和他的城市。", "第二段继续讲述这个故事，有更多的细节，也有更多的人物。"]),
    "foreign comments": (f"<html><body>{NAV}<article><h1>Titel</h1>{TWO}<div id=\"kommentare\"><ol><li><p>Sehr guter Artikel, danke!</p></li>"
                         "<li><p>Das sehe ich ganz anders, aber gut geschrieben.</p></li></ol></div></article></body></html>", ["Titel", *SAID]),
    "open comment": (f"<html><body>{NAV}<article><h1>Title</h1>{TWO}<!-- unclosed <p>x</p></article></body></html>", ["Title", *SAID]),
    "inline": (f"<html><body>{NAV}<article><h1>Title</h1><p>One line <svg><path d='x'/></svg>with an icon, <script>a()</script>a script and "
               f"<my-tag>an unknown</my-tag> element in it, all one block.</p>{TWO}</article></body></html>",
               ["Title", "One line with an icon, a script and an unknown element in it, all one block.", *SAID]),
    "one paragraph": ("<p>Only paragraph.</p>", ["Only paragraph."]),
    "menu alone": (f"<html><body>{NAV}<div class=ad><p>Buy now</p></div><footer><p>&copy; x</p></footer></body></html>", []),
    "script with a mark": (f"<html><body><article><h1>Title</h1>{TWO}</article><script>x = '<!--'</script></body></html>", ["Title", *SAID]),
}


def extracted(html, model=None):
    page = html_gbt.Page(html)
    x, own, total = html_gbt.features(page)
    verdict = html_gbt.decode(page, (model or html_gbt.trained()).probability(x), own, total)
    return page, own, verdict, html_gbt.text_of(page, verdict)


@pytest.mark.parametrize("name", list(PAGES))
def test_html_beyond_the_fixture(name):
    html, want = PAGES[name]
    assert extracted(html)[3].split("\n") == (want or [""])


@pytest.mark.parametrize("style,least", [("linked", 0.85), ("figures", 0.95), ("unsegmented", 0.95), ("bare", 0.9)])
def test_html_held_out_styles(style, least):
    """Accuracy on pages of a style that the model has not seen."""
    model, good, all_text = html_gbt.trained(150, tuple(s for s in html_gbt.STYLES if s != style)), 0, 0
    for seed in range(60_000, 60_030):
        page, own, verdict, _ = extracted(html_gbt._Writer(seed, (style,)).page(), model)
        truth = np.array([m == "1" for m in page.marks])
        good, all_text = good + own[verdict == truth].sum(), all_text + own.sum()
    assert good / all_text > least, good / all_text


def test_html_no_page_with_a_paragraph_is_empty():
    for style in ("short", "bare", "linked"):
        for seed in range(70_000, 70_060):
            assert extracted(html_gbt._Writer(seed, (style,)).page())[3]


def test_html_unclosed_silent_elements_lose_no_text():
    def said(html):
        return " ".join(" ".join(t for *_, t, _ in html_gbt.Page(html).texts).split())
    for head in ("<head><title>t</title>", "<head><meta charset=x><title>t</title><style>a{}</style><script>b</script>", "<head>"):
        assert said(f"<html>{head}<body><article>One</article></body></html>") == "One"
        assert said(f"<html>{head}<article>One</article>") == "One"
        assert said(f"<html>{head}</head><body><article>One</article>") == "One"
        assert said(f"{head}One <b>two</b>") == "One two"
    for tag in ("button", "select", "noscript", "svg", "object", "canvas", "video"):
        inner = "x" if tag != "select" else "<option>x"
        assert said(f"<body><div><p>One</p><{tag}>{inner}<p>Two</p></div><p>Three</p></body>") == "One Two Three", tag
        assert said(f"<body><div>One<{tag}>{inner}</div>Two</body>") == "One Two", tag
        assert said(f"<body><div>One<{tag}>{inner}<p>Two</div><{tag}>{inner}</{tag}>Three</body>") == "One Two Three", tag
        # a closed one keeps all its content to itself, blocks too
        assert said(f"<body><div>One<{tag}><div><p>x</p></div></{tag}>Two</div></body>") == "One Two", tag
    assert said("<head><noscript><p>x</p></noscript><title>t</title></head><body>One") == "One"


def segments(words):
    if not words:
        return {(): 0.0}

    def of(word, a):
        if a == len(word):
            return [((), 0.0)]
        return [(ids + r, p + q) for ids, b, p in word[a] for r, q in of(word, b)]
    return {x + y: p + q for x, p in of(words[0], 0) for y, q in segments(words[1:]).items()}


def test_gumbel_samples_against_enumeration():
    lattice = gumbel_pieces.lattice(None, 1.0)
    every = segments([lattice.word(w) for w in gumbel_pieces._CHUNKS(gumbel_pieces.escape("then it"))])
    assert abs(sum(map(math.exp, every.values())) - 1) < 1e-9
    first, estimate, n = collections.Counter(), collections.Counter(), 4000
    for seed in range(n):
        out = gumbel_pieces.sample(lattice, "then it", 4, seed)
        assert len({tuple(ids) for ids, *_ in out}) == 4
        assert [g for _, _, g, _ in out] == sorted((g for _, _, g, _ in out), reverse=True)
        first[tuple(out[0][0])] += 1
        for ids, phi, _, chance in out:
            assert abs(every[tuple(ids)] - phi) < 1e-9
            estimate[tuple(ids)] += math.exp(phi) / chance / n
    for ids, p in sorted(every.items(), key=lambda x: -x[1])[:3]:
        assert abs(first[ids] / n - math.exp(p)) < 0.04
        assert abs(estimate[ids] - math.exp(p)) < 0.01  # inclusion scores weigh the sample right
    assert len(gumbel_pieces.sample(lattice, "ab", 50, 1)) == len(segments([lattice.word(gumbel_pieces.SPACE + "ab")]))


def test_arrays_sample_by_the_same_law():
    lattice, n, k = gumbel_pieces.lattice(None, 1.0), 6000, 3
    words = ["▁then", "it", "▁ü😀x", "▁" * 3, "x" * 60]
    chains = gumbel_pieces.Chains(lattice, words)
    for text, start in zip(words, chains.start.tolist()):
        want, at = lattice.word(text), {0: start}
        for a in range(len(text)):
            if a in at:
                e0, e1 = chains.first[at[a]:at[a] + 2].tolist()
                got = {len(text) - end: w for end, w in zip(chains.to[e0:e1].tolist(), chains.log[e0:e1].tolist())}
                assert e1 - e0 == len(want[a])
                at |= {b: t for (_, b, _), t in zip(want[a][::-1], chains.to[e0:e1].tolist())}
                for (_, _, w), x in zip(want[a][::-1], chains.log[e0:e1].tolist()):
                    assert abs(w - x) < 1e-9, (text, a, got)
    texts = ["then it"] * n
    fast = gumbel_pieces.sample_many(lattice, texts, k, list(range(n)))
    slow = [gumbel_pieces.sample(lattice, "then it", k, seed) for seed in range(n)]
    for j in range(k):
        a, b = (collections.Counter(tuple(map(int, made[j][0])) for made in x) for x in (fast, slow))
        for ids, count in b.most_common(4):
            assert abs(a[ids] - count) / n < 0.035
        a, b = (np.array([made[j][2] for made in x]) for x in (fast, slow))
        assert abs(a.mean() - b.mean()) < 0.08 and abs(a.std() - b.std()) < 0.08
        a, b = (np.array([made[j][3] for made in x]) for x in (fast, slow))
        assert abs(a.mean() - b.mean()) < 0.03
    for made in fast:
        assert len({x[0].tobytes() for x in made}) == k and all(x[4] for x in made)


@pytest.mark.parametrize("text,n", [("then it", 40_000), ("no one was there", 20_000), ("ü it  x", 20_000)])
def test_array_search_against_enumeration(text, n):
    """First and second draws of several words: their exact probabilities, perturbed scores and inclusion."""
    lattice = gumbel_pieces.lattice(None, 1.0)
    words = [lattice.word(w) for w in gumbel_pieces._CHUNKS(gumbel_pieces.escape(text))]
    chance = {ids: math.exp(phi) for ids, phi in segments(words).items()}
    assert abs(sum(chance.values()) - 1) < 1e-6
    made = gumbel_pieces.sample_many(lattice, [text] * n, 2, [7919 * x for x in range(n)])
    first = collections.Counter(tuple(m[0][0].tolist()) for m in made)
    second = collections.Counter(tuple(m[1][0].tolist()) for m in made)
    assert set(first) | set(second) <= set(chance)
    likely = sorted(chance, key=chance.get)[-6:]
    for ids in likely:
        p = chance[ids]
        q = sum(r * p / (1 - r) for other, r in chance.items() if other != ids)
        for found, want in ((first[ids], p), (second[ids], q)):
            assert abs(found / n - want) < 4.5 * math.sqrt(want * (1 - want) / n) + 1e-4, (ids, found / n, want)
    g = np.array([m[0][2] for m in made])
    assert abs(g.mean() - 0.5772) < 0.05 and abs(g.std() - math.pi / math.sqrt(6)) < 0.05
    assert all(m[0][2] >= m[1][2] for m in made)
    # weighted by 1 / inclusion, each segmentation counts once on average (Horvitz and Thompson)
    weight = collections.Counter()
    for m in made:
        for ids, _, _, inclusion, ok in m:
            weight[tuple(ids.tolist())] += chance[tuple(ids.tolist())] / inclusion / n
            assert ok
    assert abs(sum(weight.values()) - 1) < 0.1
    for ids in likely[-3:]:
        assert abs(weight[ids] / chance[ids] - 1) < 0.15


def test_long_texts_are_searched_like_others():
    """One word without choices, one of many, and 30,000 words: all distinct samples, all decoding."""
    lattice = gumbel_pieces.lattice(None, 1.0)
    texts = ["\u6f22\u5b57" * 10_000, "x" * 30_000, "then it was " * 10_000, "  ", "a b"]
    made = gumbel_pieces.sample_many(lattice, texts, 4, [5] * len(texts))
    assert [len(m) for m in made] == [1, 4, 4, 4, 4]
    for text, m in zip(texts, made):
        assert len({x[0].tobytes() for x in m}) == len(m) and all(x[4] for x in m)
        assert [x[2] for x in m] == sorted((x[2] for x in m), reverse=True)
        words = [lattice.word(w) for w in gumbel_pieces._CHUNKS(gumbel_pieces.escape(text))] if len(text) < 100 else None
        if words:
            every = segments(words)
            assert all(abs(every[tuple(x[0].tolist())] - x[1]) < 1e-9 for x in m)


def test_samples_have_no_rounding_from_the_texts_beside_them():
    """Of one slice or alone, long and short, empty in between: equal to the last bit."""
    import random
    rnd = random.Random(7)
    words = ["then", "it", "was", "onthe", "\u6f22\u5b57", "x1y2", "reading", "un\u00efted", "aaaaaaaaaaaa"]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 40, 700]))) for _ in range(60)]
    lattice, seeds = gumbel_pieces.lattice(None, 1.0), list(range(60))
    for text, seed, made in zip(texts, seeds, gumbel_pieces.sample_many(lattice, texts, 4, seeds)):
        alone = gumbel_pieces.sample_many(lattice, [text], 4, [seed])[0]
        assert [(x[0].tolist(), *x[1:3]) for x in made] == [(x[0].tolist(), *x[1:3]) for x in alone]


def test_words_that_end_alike_share_their_places():
    """A place for each different ending, long words' beginnings apart; every place's pieces as of its word alone."""
    shared = gumbel_pieces.SHARED
    words = ["\u2581reading", "\u2581leading", "\u2581x\u6f22ing", "ing", "\u2581" + "a" * (shared - 1), "b" + "a" * (shared + 5),
             "\u2581\U0001f600" + "a" * (shared + 5), "\u2581reading" * 9]
    lattice = gumbel_pieces.lattice(None, 1.0)
    chains = gumbel_pieces.Chains(lattice, words)
    endings = {w[-m:] for w in words for m in range(1, min(len(w), shared) + 1)}
    assert len(chains.first) - 2 == len(endings) + sum(max(0, len(w) - shared) for w in words)
    for word, node in zip(words, chains.start.tolist()):
        node_at = {0: node}
        for a, edges in enumerate(lattice.word(word)):
            if a not in node_at:
                continue
            e0, e1 = chains.first[node_at[a]:node_at[a] + 2].tolist()
            assert e1 - e0 == len(edges)
            for (ids, b, log), e in zip(edges[::-1], range(e0, e1)):
                assert gumbel_pieces.spell(lattice, chains.ids[e:e + 1])[0].tolist() == list(ids)
                assert abs(chains.log[e] - log) < 1e-9
                assert node_at.setdefault(b, int(chains.to[e])) == chains.to[e]
        assert node_at[len(word)] == 0


def test_segmentations_are_of_every_document_and_of_its_text_alone(spark, docs, sf_dir):
    got = collections.defaultdict(list)
    for r in LLM_QUERIES["op3_sentencepiece_sampling"](spark, sf_dir).collect():
        got[r.doc_id].append(r)
    assert set(got) == {r.doc_id for r in docs.collect()}
    lattice, texts = gumbel_pieces.lattice(None, 1.0), {r.doc_id: r.text or "" for r in docs.collect()}
    for key, rows in got.items():
        assert all(r.decoded and gumbel_pieces.decode(r.ids, lattice.pieces) == texts[key] for r in rows)
        seed = xxhash.xxh64_intdigest(repr((key,)).encode())
        alone = gumbel_pieces.sample_many(lattice, [texts[key]], 4, [seed])[0]
        assert {r.sample: (r.ids, r.perturbed) for r in rows} == {
            j: (x[0].tolist(), x[2]) for j, x in enumerate(alone, 1)}
        if len(texts[key]) > 40:
            assert sorted(r.sample for r in rows)[:4] == [1, 2, 3, 4] or len(rows) == 8


def test_pieces_decode_as_sentencepiece_does():
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    lattice = gumbel_pieces.lattice(None, 1.0)
    for text in ("I am  here", "ünï😀 x\ty\n", "  two"):
        for ids, *_ in gumbel_pieces.sample(lattice, text, 5, 11):
            assert gumbel_pieces.decode(ids, lattice.pieces) == text == model.decode(ids)


def test_quality_classifier_held_out(spark):
    """Fitted on half of the labels of sf0.01, judged on the other half."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_bayes.judge_sites(docs, labels.where("doc_id % 2 = 0"), host="source", path="lang")
    rows = got.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    assert np.mean([bool(r.quality) == r.kept for r in rows]) > 0.97


def test_sparse_sites_shrink_to_the_prior(spark):
    rows = [(i, "good prose here, in some words " * 5, "big", "a") for i in range(60)] + [(99, "good prose here, in some words " * 5, "new", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = {r.host: r for r in quality_bayes.judge_sites(docs, labels).select("host", "path_share", "probability").distinct().collect()}
    assert got["new"].path_share == pytest.approx(0.5) and got["big"].probability == pytest.approx(0.5)


def test_site_shares_and_odds_against_plain_python(spark):
    """Sparse and hot sites, null hosts and paths, repeated ids and labels: everything after the evidence, recomputed."""
    rnd = random.Random(9)
    say = lambda n: " ".join(rnd.choice(["good", "words", "are", "here", "#$%", "AAAA", "1"]) for _ in range(n))
    rows = [(i, say(rnd.randint(0, 60)), rnd.choice(["a", "a", "a", "b", None, f"sparse{i}"]), rnd.choice(["x", "y", None])) for i in range(150)]
    rows += [rows[3], (3, "another text of the same id", "b", "x"), (None, say(9), "a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, "k") for i in range(0, 150, 2)] + [(4, 1, "k"), (4, 1, "k"), (3, 1, "k"), (5, 0, "k"), (7, 0, "k"),
                                                                                  (None, 1, "k"), (9, None, "k")], "doc_id long, quality int, y string")
    x = {i: np.array(quality_bayes.measures((t or "").encode())) for i, (_, t, _, _) in enumerate(rows)}
    sample = []
    for k, y in sorted({(k, y) for k, y, _ in labels.collect() if k is not None and y is not None}):
        same = [tuple(x[i]) for i, r in enumerate(rows) if r[0] == k]
        if same:
            sample.append((min(same), float(y)))
    model = quality_bayes.Classifier(np.array([s for s, _ in sample]), np.array([y for _, y in sample]))
    odds = model.log_odds(np.stack([x[i] for i in range(len(rows))]))
    p = 1 / (1 + np.exp(-odds))
    mean = float(np.clip(p.mean(), 1e-3, 1 - 1e-3))

    def strength(groups):
        n, share = np.array([len(g) for g in groups], float), np.array([np.mean(g) for g in groups])
        within, spread = mean * (1 - mean), n.sum() - (n ** 2).sum() / n.sum()
        tau2 = ((n * (share - mean) ** 2).sum() - (len(n) - 1) * within) / spread
        return float(np.clip(within / tau2 if tau2 > 0 else np.inf, *quality_bayes.PRIOR_ROWS))
    hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
    for (_, _, h, q), v in zip(rows, p):
        hosts[h].append(v)
        paths[h, q].append(v)
    above, below = strength(list(hosts.values())), strength(list(paths.values()))
    logit = lambda v: math.log(v / (1 - v))
    want = []
    for (k, _, h, q), o, v in zip(rows, odds, p):
        host_share = (sum(hosts[h]) + above * mean) / (len(hosts[h]) + above)
        share = (sum(paths[h, q]) - v + below * host_share) / (len(paths[h, q]) - 1 + below)
        share = min(max(share, 1e-3), 1 - 1e-3)
        want.append((k, h, q, o, host_share, share, 1 / (1 + math.exp(-(o + logit(share) - logit(mean))))))
    got = [tuple(r)[:7] for r in quality_bayes.judge_sites(docs, labels).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]), str(r[2]), r[3])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], atol=1e-6), (a, b)
    assert len({r[4] for r in got}) > 20
