"""The pipeline stage by stage, each against brute force on its own input."""

import collections
import random

import corpus_pipeline as P
import zstandard

from ledgerguard.llm.packing import encoder
from ledgerguard.llm.quality_rules import Bands, band_verdict, base_measures
from tests.llm.test_operators import awkward, brute_fingerprint


def test_stages(spark, tmp_path):
    texts = awkward()
    rows = [(i, t, "en", "s", len(t or ""), "extra") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k string"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert tuple(docs.columns) == P.COLUMNS
            assert all(r.n_chars == len(r.text) for r in docs.collect() if i)
        seen.append({r.doc_id: r.text for r in docs.collect()} if i < 4 else docs.collect())

    def good(t):
        n, _, _, _, repeat = base_measures(t.encode())
        return n >= 20 and 100 * repeat <= 30 * n and band_verdict(t.encode(), Bands(), zstandard.ZstdCompressor(level=3))[3]
    kept = {i: t for i, t in enumerate(texts) if good(t or "")}
    assert seen[0] == kept and len(kept) > 15
    held, lines = {}, {}
    for i, t in sorted(kept.items()):
        out = []
        for line in t.split("\n"):
            key = line.strip(" \t\r\x0b\x0c").encode().lower()
            if len(key.decode()) < 10 or held.setdefault(key, i) == i:
                out.append(line)
        lines[i] = "\n".join(out)
    assert seen[1] == lines
    fps = {i: brute_fingerprint(t) for i, t in lines.items()}
    group = {i: i for i in lines}
    for _ in lines:
        for i in lines:
            group[i] = min(group[j] for j in lines if bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert seen[2] == {i: t for i, t in lines.items() if group[i] == i}
    size = P.REPEAT_BYTES
    count = collections.Counter(t[i:i + size] for t in map(str.encode, seen[2].values()) for i in range(len(t) - size + 1))
    for i, t in seen[2].items():
        t, flag = t.encode(), set()
        for a in range(len(t) - size + 1):
            if count[t[a:a + size]] > 1:
                flag |= set(range(a, a + size))
        assert seen[3][i] == bytes(x for a, x in enumerate(t) if a not in flag).decode("utf-8", "ignore")
    import public_tokenizers
    encode = encoder(public_tokenizers.path("word_bpe_49k.json"))
    tokens = collections.Counter()
    for r in seen[4]:
        tokens[r.doc_id] += r.length
    assert tokens == {i: len(encode(t)) // 4 + 1 for i, t in seen[3].items()}
    assert [tuple(r) for r in P.run(spark, str(tmp_path)).orderBy("doc_id", "piece").collect()] == sorted(
        (tuple(r) for r in seen[4]), key=lambda r: (r[0], r[1]))


def test_repeated_passages_of_fifty_words_go(spark, tmp_path):
    """Passages of 51 words inside otherwise different documents: found twice before the stage, never after it."""
    rnd = random.Random(3)

    def say(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(n))
    passages = [say(51) for _ in range(5)]
    texts = [f"{say(40)} {passages[i % 5]} {say(40)}" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")

    def repeated(found):
        windows = [w for t in found for w in {tuple(t.split()[i:i + 50]) for i in range(len(t.split()) - 49)}]
        return sum(n > 1 for n in collections.Counter(windows).values())
    assert repeated(texts) >= 5
    kept = [r.text for r in P.suffix_array_dedup(spark, docs, str(tmp_path)).collect()]
    assert len(kept) == 20 and repeated(kept) == 0
    assert all(len(t.split()) >= 78 for t in kept)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
