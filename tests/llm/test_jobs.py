"""The pipeline keeps what it should; the queries and their SQL are covered by tests/test_oracle.py."""

import itertools
import re
import sys
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from goldspan.llm import toxicity  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_stages_feed_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns and out.schema == docs.schema
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert 0.5 * before < docs.count() <= before
            assert docs.select("doc_id").distinct().count() == docs.count()


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (3, "w " * 30, "en", "s", 60), (4, "w " * 30, "en", "s", 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_per_group(spark, docs, SMALL)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3]
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.cut_passages(spark, docs, SMALL).collect()) == [0, 1, 2, 3, 4]
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert corpus_pipeline.pack_sequences(spark, docs, SMALL).count() == 5


def test_the_whole_run_by_brute_force(spark):
    """Given the scores of the classifier, every row of every stage is worked out again in plain Python."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), F.lit(True))
    rows = toxicity.score_texts(docs, model, score="s").select("doc_id", "text", "s").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in rows if r["s"] < 0.3}
    assert 0 < len(texts) < len(rows)
    lower = {i: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[^\x20\x09-\x0d]+", t)] for i, t in texts.items()}
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for i, w in lower.items()}
    root = {i: i for i in texts}

    def find(i):
        return i if root[i] == i else find(root[i])
    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    texts = {i: t for i, t in texts.items() if find(i) == i}
    assert len(texts) < len(root)
    words = {i: re.findall("[^\x20\x09-\x0d]+", t) for i, t in texts.items()}
    least = {}
    for i in sorted(words, reverse=True):
        least.update({tuple(words[i][j:j + 13]): i for j in range(len(words[i]) - 12)})
    changed = 0
    for i, w in words.items():
        gone = {k for j in range(len(w) - 12) if least[tuple(w[j:j + 13])] < i for k in range(j, j + 13)}
        if gone:
            changed += 1
            texts[i] = " ".join(x for k, x in enumerate(w) if k not in gone)
    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path("byte_bpe_50k.json"))
    want = set()
    for i, t in texts.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        at, size, piece = 0, len(ids) % 2048 or 2048, 0
        while at < len(ids):
            want.add((i, piece, at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())))
            at, size, piece = at + size, 2048, piece + 1
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert len(out) == len(want) and {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out} == want and changed > 0
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in bins.values():
        found.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(found, found[1:])) and found[0][0] == 0 and sum(found[-1]) <= 2048


def test_texts_go_to_python_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    for given, then in (("64m", f"{corpus_pipeline.BATCH}b"), ("1g", f"{corpus_pipeline.BATCH}b"), ("4m", "4m"), ("100", "100")):
        spark.conf.set(name, given)
        corpus_pipeline._small_batches(spark)
        assert spark.conf.get(name) == then
    spark.conf.set(name, before)
