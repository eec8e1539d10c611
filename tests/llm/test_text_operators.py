"""Operators on texts against the libraries and brute force, with nulls, empty tables and odd rows."""

import hashlib
import itertools
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from goldspan.llm import bpe, chat, classlm, packing, passages, similarity, tokens, toxicity  # noqa: E402
from goldspan.llm.vocabulary import vocabulary  # noqa: E402

FILE = tokenizer_path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, slab int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def odd_texts(seed=5, many=120):
    rng = random.Random(seed)
    bits = ["the", " of", "  ", "\n", "\t", "<|endoftext|>", "<|endo", "'s", "!!", "日本", "é", "😀", "x" * 90, "12", "\x85", " "]
    return ["", " ", None, "a", *("".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(many)), "the " * 9000]


def documents(spark, texts, ids=None):
    """With a null id, a repeated row and columns whose names clash with the operators' own."""
    rows = [(i, t, None, "s", None, "mine", 7) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_encoding_and_counts_are_the_librarys(spark, library):
    texts = odd_texts()
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    df = documents(spark, texts).drop("ids")
    got = {r["doc_id"]: r for r in bpe.encode_texts(df, FILE, decoded="decoded").collect()}
    for i, (t, ids) in enumerate(zip(texts, want)):
        assert got[i]["ids"] == ids and got[i]["decoded"] == (t or "")
    counted = {r["doc_id"]: r["n_tokens"] for r in tokens.sizes(df, FILE, 1024).collect()}
    assert counted == {i: len(ids) for i, ids in enumerate(want)}
    back = bpe.decode_ids(spark.createDataFrame([(1, want[-1]), (2, None), (3, [])], "i int, ids array<int>"), FILE).collect()
    assert [r["decoded"] for r in back] == [texts[-1], None, ""]
    assert bpe.encode_texts(df.limit(0), FILE).count() == 0 and tokens.sizes(df.limit(0), FILE, 1).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_texts(documents(spark, ["a"]), FILE)


def test_chunks_meet_where_whole_texts_are_cut(library):
    counter = tokens.ChunkCounter(vocabulary(FILE), chunk=40, overlap=4)
    for text in odd_texts(9, 400):
        assert counter.count(text or "") == len(library.encode(text or "", add_special_tokens=False).ids)


def test_packing_is_whole_and_tight(spark, library):
    texts = odd_texts()
    got = packing.pack_documents(documents(spark, texts), FILE, 64).collect()
    of = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    for i, ids in of.items():
        mine = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine))) and sum(r["length"] for r in mine) == len(ids)
        for r in mine:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        assert all(r["length"] == 64 for r in mine[1:])
    bins = {k: sorted((r["offset"], r["length"]) for r in v) for k, v in itertools.groupby(
        sorted(got, key=lambda r: r["sequence_id"]), key=lambda r: r["sequence_id"])}
    for held in bins.values():
        assert [o for o, _ in held] == list(itertools.accumulate([0] + [n for _, n in held]))[:-1]
        assert sum(n for _, n in held) <= 64
    assert len(bins) <= -(-sum(r["length"] for r in got) // 64) + 1
    assert packing.pack_documents(documents(spark, ["a"]).limit(0), FILE, 64).count() == 0


def test_two_smaller_ones_replace_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[7, 2, 3]] = 1, 1, 0
    assert packing.filling(counts, 10) == {7: 1, 2: 1}
    counts = np.zeros(21, np.int64)
    counts[[10, 9, 6, 5]] = 1, 1, 1, 1  # 10 + 9 leaves 1; 9 gives way to none, as 6 + 5 is too long
    assert packing.filling(counts, 20) == {10: 1, 9: 1}
    counts[[5, 4]] = 1, 1  # 6 + 4 fills the gap that 9 leaves
    assert sum(k * v for k, v in packing.filling(counts, 20).items()) == 20


def words(rng, many, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(many)]


def test_repeated_passages_go(spark):
    rng = random.Random(3)
    shared = words(rng, 40)
    texts = [None, "", "a b", " ".join(shared)]
    for i in range(30):
        own = words(rng, 60)
        if i % 3:
            at = rng.randrange(50)
            own[at:at] = shared[rng.randrange(10):][: rng.randint(5, 30)]
        texts.append(" \n".join(own))
    texts += [texts[5], texts[5], " ".join(["r"] * 30)]
    ids = [*range(3, len(texts) + 2), None]
    starts: dict = {}
    cut = [(t or "").split() for t in texts]
    for i, w in zip(ids, cut):
        for j in range(len(w) - 12):
            if i is not None:
                key = tuple(w[j:j + 13])
                starts[key] = min(starts.get(key, i), i)
    want = []
    for i, w in zip(ids, cut):
        gone = {k for j in range(len(w) - 12) if i is not None and starts[tuple(w[j:j + 13])] < i for k in range(j, j + 13)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    df = documents(spark, texts, ids)
    got = [tuple(r) for r in passages.remove_passages(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[2] for w in want) > 100
    assert passages.remove_passages(df.limit(0)).count() == 0
    kept = passages.rewrite(df, ["doc_id", "lang"]).collect()
    by_id = {w[0]: w for w in want}
    assert len(kept) == len(want) and any(w[1] and w[1] == w[2] for w in want)  # a row that loses all its words stays, empty
    for r in kept:
        if by_id[r["doc_id"]][2]:
            assert r["text"] == by_id[r["doc_id"]][3] and r["n_chars"] == len(r["text"])


def test_similar_documents_by_brute_force(spark):
    rng = random.Random(4)
    base = [words(rng, 60, 5000) for _ in range(4)]
    texts = [None, "", "One Two", "one two", "one two three", "a b c d e", "A B C D E f"]
    for b in base:
        for _ in range(8):
            w = list(b)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w[rng.randint(0, 4):]))
    texts += [texts[9], "x " * 5000]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    ids = [10 + 3 * i for i in range(len(texts))]
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])
    for (i, a), (j, b) in itertools.combinations(zip(ids, sets), 2):
        if a and 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    df = documents(spark, texts, ids)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similarity.similar_documents(df).collect()}
    assert got == {i: (len(s), find(i)) for i, s in zip(ids, sets)}
    assert len({c for _, c in got.values()}) < len(ids) - 5
    assert similarity.similar_documents(df.limit(0)).count() == 0
    lone = similarity.similar_documents(documents(spark, ["a b c d e f"], [None])).collect()
    assert [tuple(r) for r in lone] == [(None, 2, None)]


def test_toxicity_is_learned_from_positive_and_unlabelled(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        w = words(rng, 40, 3000)
        if bad:
            w[3:3] = rng.sample(["vile", "rotten", "foulish"], 2)
        rows.append((i, " ".join(w)))
        if i % 3 == 0:
            labels.append((i, int(bad)))
    df = spark.createDataFrame([(i, t, "en", "s", 1, 0.5) for i, t in rows] + [(None, None, None, None, None, 0.1)],
                               "doc_id long, text string, lang string, source string, n_chars long, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.scores(df, marks).collect()
    assert len(got) == 901 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum((r["doc_id"] % 5 == 0) == bool(r["predicted"]) for r in held) > 0.9 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert toxicity.scores(df.limit(0), marks.limit(0)).count() == 0
    assert toxicity.scores(df, marks.limit(0)).count() == 901


def test_class_model_counts_and_beats_the_base(spark):
    rng = random.Random(6)
    names, verbs = [f"n{i}" for i in range(30)], [f"v{i}" for i in range(30)]
    texts = [" ".join(x for _ in range(20) for x in (rng.choice(names), rng.choice(verbs).upper())) for _ in range(200)]
    texts += [None, "", "never seen words", "n1 v1 only once"]
    ids = list(range(len(texts)))
    got = {r["doc_id"]: r for r in classlm.scores(documents(spark, texts)).collect()}
    train = [i for i in ids if zlib.crc32(str(i).encode()) % 7 != 2]
    counts: dict = {}
    for i in train:
        for w in (texts[i] or "").lower().split() + [""]:
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    for i in ids:
        line = (texts[i] or "").lower().split() + [""]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(line), sum(w in counts for w in line), total)
        assert abs(r["base_score"] - sum(np.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in line)) < 1e-6
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert classlm.scores(documents(spark, ["a"]).limit(0)).count() == 0


def test_words_beyond_the_head_get_classes_by_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(classlm, "HEAD", 41)
    monkeypatch.setattr(classlm, "MOVED", 41)
    rng = random.Random(3)
    names, verbs = [f"n{i}" for i in range(20)], [f"v{i}" for i in range(20)]
    texts = [" ".join(x for _ in range(20) for x in (rng.choice(names), rng.choice(verbs))) for _ in range(60)]
    texts += [f"{rng.choice(names)} w{i % 30} x{i % 30} {rng.choice(verbs)}" for i in range(120)]  # w stands like v, x like n
    df = documents(spark, texts)
    model, classed = classlm.train(df, F.lit(True))
    got = {bytes(r["word"]).decode(): r["class"] for r in classed.collect()}
    assert set(got) == {f"{k}{i}" for k in "wx" for i in range(30)}
    of = lambda word: int(model.class_of[model.place[word.encode()]])
    classes = {k: {of(f"{k}{i}") for i in range(20)} for k in "nv"}
    assert not classes["n"] & classes["v"]
    assert all(c in classes["v" if w[0] == "w" else "n"] for w, c in got.items())
    lines = [t.split() for t in texts]
    counts = {w: sum(line.count(w) for line in lines) for w in {w for line in lines for w in line}}
    both = {**got, **{w.decode(): of(w.decode()) for w in model.place if w}}
    tokens = {k: sum(n for w, n in counts.items() if both[w] == k) for k in set(both.values())}
    scores = {r["doc_id"]: r["score"] for r in classlm.score_texts(df, model, classed).collect()}
    for i in (0, 60, 70, 179):  # against the sum over the words
        path = [classlm.STOPS, *[both[w] for w in lines[i]], classlm.STOPS]
        want = sum(np.log10(counts[w] / tokens[both[w]]) for w in lines[i]) + sum(model.transition[a, b] for a, b in zip(path, path[1:]))
        assert abs(scores[i] - want) < 1e-6


def test_class_model_splits_texts_once(spark):
    split = spark.sparkContext.accumulator(0)

    def told(text):
        split.add(1)
        return text
    df = documents(spark, [f"a b{i % 7} c{i}" for i in range(60)]).withColumn("text", F.udf(told, "string").asNondeterministic()("text"))
    assert classlm.scores(df).count() == 60
    assert split.value == 60


def test_class_model_does_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(12)
    odd = [" Lead and  trail\t", "x\x1cy z", "\x0b\x0c\r\n", "\u00a0Ä É\u2003b", "", None, "only " * 400]
    texts = [" ".join(rng.choice((f"n{rng.randrange(20)}", f"v{rng.randrange(90)}")) for _ in range(12)) for _ in range(150)] + odd
    ids = [*range(len(texts) - 2), None, 3]
    df = documents(spark, texts, ids)

    def rows():
        return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"]), (r["base_score"], r["score"]))
                      for r in classlm.scores(df).collect())
    monkeypatch.setattr(classlm, "HEAD", 33)  # cuts among words that are equally frequent
    whole = rows()
    monkeypatch.setattr(classlm, "BLOCK", 300)  # many blocks, some of one long text
    monkeypatch.setattr(classlm, "BUCKET", 500)
    blocks = rows()
    assert [a for a, _ in whole] == [a for a, _ in blocks]
    np.testing.assert_allclose([x for _, x in whole], [x for _, x in blocks], atol=1e-8)
    assert sorted(a[2] for a, _ in whole) == sorted(len((t or "").encode().split()) + 1 for t in texts)
    model, classed = classlm.train(df, F.lit(True))
    counts: dict = {}
    for t in texts:
        for w in (t or "").encode().lower().split():
            counts[w] = counts.get(w, 0) + 1
    order = sorted([*counts, b""], key=lambda w: (-(counts[w] if w else len(texts)), w))
    assert list(model.place) == order[:33]
    assert {bytes(r["word"]): r["c"] for r in classed.collect()} == {w: counts[w] for w in order[33:]}


def test_exchange_separates_what_follows_each_other():
    pairs = np.zeros((7, 7))
    for a in range(3):
        for b in range(3, 6):
            pairs[a, b] = pairs[b, a] = 50 + a + b
    own = classlm.exchange(pairs, 6, 2)
    assert len(set(own[:3])) == 1 and len(set(own[3:6])) == 1 and own[0] != own[3]


def test_preference_pairs(spark):
    turn = "array<struct<role:string,text:string>>"
    a = [("user", "hi"), ("assistant", "yes")]
    b = [("user", "hi"), ("assistant", "no"), ("user", "why"), ("assistant", "so")]
    df = spark.createDataFrame([(1, a, b), (2, a, a), (3, a, None), (4, [], a), (5, a[:1], a)], f"i int, chosen {turn}, rejected {turn}")
    got = {r["i"]: r for r in chat.preference_pairs(df).collect()}
    assert set(got) == {1, 4, 5}
    assert got[1]["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and got[1]["n_prompt_turns"] == 1
    for i, side, turns in ((1, "chosen", a), (1, "rejected", b), (4, "rejected", a)):
        text, mask = got[i][f"{side}_text"], got[i][f"{side}_mask"]
        learned = [text[int(s):int(e)] for s, e in (x.split(":") for x in mask.split(",") if x)]
        assert learned == [t + "<|im_end|>\n" for r, t in turns if r == "assistant"]
    assert (got[4]["chosen_text"], got[4]["chosen_mask"], got[5]["chosen_text"]) == ("", "", "")
    rows = spark.createDataFrame([(0, 0, "user", "q"), (0, 1, "assistant", "x"), (0, 1, "assistant", "x"), (1, 0, None, None),
                                  (1, 1, "assistant", "y"), (None, 1, "user", "z"), (2, 0, "user", "q")], "conv_id long, turn long, role string, text string")
    assert sorted(r["conv_id"] for r in chat.swapped_replies(rows).collect()) == [0, 1]
    assert chat.swapped_replies(rows.limit(0)).count() == 0


def test_every_conversation_with_a_reply_is_paired(spark):
    # even ids only, replies of one's own, one to three of them, and a conversation without a reply
    talks = {i: [(r, f"{r} {i} {k}") for k in range(1 + i // 2 % 3) for r in ("user", "assistant")] for i in range(0, 60, 2)}
    talks[33] = [("user", "alone")]
    talks[70] = [*talks[4], ("user", "after")]
    rows = [(i, k, r, t) for i, turns in talks.items() for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.branched_replies(df).collect()}
    ids = [i for i in sorted(talks) if i != 33]
    assert sorted(got) == ids
    show = lambda turns: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        a, b = (t[:-1] if t[-1][0] == "user" else t for t in (talks[i], talks[j]))
        k = zlib.crc32(str(i).encode()) % (len(a) // 2)
        p, q = 2 * k + 1, 2 * min(k, len(b) // 2 - 1) + 1
        r = got[i]
        assert (r["n_prompt_turns"], r["prompt"]) == (p, show(a[:p]))
        assert (r["chosen_text"], r["rejected_text"]) == (show(a[p:]), show(b[q:]))
        for side, turns in (("chosen", a[p:]), ("rejected", b[q:])):
            learned = [r[f"{side}_text"][int(s):int(e)] for s, e in (x.split(":") for x in r[f"{side}_mask"].split(","))]
            assert learned == [t + "<|im_end|>\n" for role, t in turns if role == "assistant"]
    assert any(r["chosen_mask"].count(",") for r in got.values()) and any(r["rejected_mask"].count(",") for r in got.values())
    assert chat.branched_replies(df.limit(0)).count() == 0


def test_digest_columns(spark):
    got = bpe.digests(bpe.encode_texts(documents(spark, ["a b"]).drop("ids"), FILE, decoded="decoded")).first()
    ids = Tokenizer.from_file(FILE).encode("a b").ids
    assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got["decoded_sha256"] == hashlib.sha256(b"a b").hexdigest()
