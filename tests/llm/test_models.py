"""Importance resampling (6), piece coding (7) and language identification (8)."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aisle.llm import importance, language, pieces
from aisle.llm import kernels as K
from tests.llm.conftest import DOCS, edge_texts, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.1"


# ---- importance resampling ---------------------------------------------------

def features(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return Counter([(x,) for x in w] + list(zip(w, w[1:])))


def buckets():
    """n-gram -> bucket, read off single n-grams."""
    def of(gram):
        h, _ = importance.grams(K.texts_of(pa.array([" ".join(gram)])))
        return int(h[-1])
    return of


def test_weights_equal_brute_force(spark, edge_docs):
    labels = spark.createDataFrame([(d, 1 if d % 2 else 0, 1 if d % 5 == 0 else 0) for d in range(0, 120)] + [(None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = edge_docs.select("doc_id", "text")
    model = importance.fit(docs, labels)
    of = buckets()
    rows = [(r.doc_id, features(r.text)) for r in docs.collect()]
    raw, aim = Counter(), Counter()
    seen = {}
    for d, f in rows:
        for g, n in f.items():
            b = seen.setdefault(g, of(g))
            raw[b] += n
            aim[b] += n if d < 120 and d % 2 and d % 5 else 0
    nr, na = sum(raw.values()) + importance.BUCKETS, sum(aim.values()) + importance.BUCKETS
    scored = {r.doc_id: r.log_weight for r in importance.scored(docs.withColumn("noise_key", F.lit(5).cast("long")), model).collect()}
    for d, f in rows:
        want = sum(n * (math.log((aim[seen[g]] + 1) / na) - math.log((raw[seen[g]] + 1) / nr)) for g, n in f.items())
        assert abs(scored[d] - want) < 1e-6 * max(1, abs(want))
    good = sum(d < 120 and d % 2 for d, _ in rows)
    bad = sum(d < 120 and not d % 2 for d, _ in rows)
    assert model.keep == math.ceil(len(rows) * min(1, good / (good + bad) + importance.SLACK))


def test_share_counts_every_label_of_the_input(spark):
    from aisle.llm.queries import share_code
    share_code(spark)
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, 0).otherwise(1).alias("quality"),
                                         F.lit(0).alias("toxic"))
    ids = [i for i in range(0, 60, 5)] + [i for i in range(60) if i % 5] + [5, 5, None]
    docs = spark.createDataFrame([(i, "some words here") for i in ids], "doc_id long, text string")
    good, bad = sum(i is not None and i % 5 > 0 for i in ids), sum(i is not None and i % 5 == 0 for i in ids)
    assert importance.fit(docs, labels).keep == math.ceil(len(ids) * (good / (good + bad) + importance.SLACK))


def test_gumbel_noise_is_standard(spark):
    model = importance.Model(np.zeros(importance.BUCKETS), 0, 0)
    df = spark.range(100000).select(F.lit("").alias("text"), importance._noise(F.col("id"), F.lit("x")).alias("noise_key"))
    k = -importance.scored(df, model).toPandas().rank_key
    assert abs(k.mean() - 0.5772) < 0.02 and abs(k.var() - math.pi ** 2 / 6) < 0.06


@pytest.mark.parametrize("k", [0, 1, 7, 500, 2999, 3000, 9999, 10000, 20000])
def test_kth_smallest(spark, k):
    df = spark.range(10000).select((F.when(F.col("id") < 3000, 0.5).otherwise(F.sqrt("id")) * F.lit(1.0)).alias("x"))
    got = importance.kth_smallest(df, "x", k, 10000, small=50)
    values = sorted([0.5] * 3000 + [math.sqrt(i) for i in range(3000, 10000)])
    assert got == (-math.inf if k < 1 else math.inf if k >= 10000 else values[k - 1])


def test_resampling_keeps_clean_and_drops_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = importance.resample_documents(docs, labels)
    assert kept.columns == docs.columns
    q = {(r.quality, r.k): r.n for r in labels.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left")
         .groupBy("quality", F.coalesce("k", F.lit(0)).alias("k")).agg(F.count("*").alias("n")).collect()}
    assert q[(1, 1)] / (q[(1, 1)] + q.get((1, 0), 0)) > 0.97
    assert q.get((0, 1), 0) / (q[(0, 0)] + q.get((0, 1), 0)) < 0.15


def test_resampling_without_labels_and_nothing(spark, edge_docs, empty_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.resample_documents(edge_docs, none).count() == edge_docs.count()
    some = spark.createDataFrame([(0, None, None), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert importance.resample_documents(edge_docs, some).count() == math.ceil(edge_docs.count() * importance.SLACK)
    assert importance.resample_documents(empty_docs, some).count() == 0


def test_importance_query(spark, edge_docs, table):
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    folder = table(documents=edge_docs, labels=labels)
    out = importance.op6_importance_resampling(spark, folder).collect()
    n = math.ceil(len(out) * (2 / 3 + importance.SLACK))
    order = sorted(out, key=lambda r: -r.gumbel_key)
    assert [r.kept for r in order] == [i < n for i in range(len(out))]
    kept = {r.doc_id for r in importance.resample_documents(edge_docs, labels).collect()}
    assert kept == {r.doc_id for r in out if r.kept}


# ---- pieces ------------------------------------------------------------------

def plain_viterbi(coder, vocab, s):
    """All segmentations by positions, longest last piece on ties."""
    n = len(s)
    best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
    for e in range(1, n + 1):
        best[e] = best[e - 1] + coder.unknown
        for size in range(1, min(e, 16) + 1):
            hit = vocab.get(s[e - size:e])
            if hit and best[e - size] + hit[0] >= best[e]:
                best[e], back[e] = best[e - size] + hit[0], (size, hit[1])
    out, at = [], n
    while at:
        if back[at] is None:
            out = coder._spell(s[at - 1]) + out
            at -= 1
        else:
            out = [back[at][1]] + out
            at -= back[at][0]
    return out


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.vocabulary_path())


def fuzz():
    rng = random.Random(2)
    chars = ["a", "th", "e ", " ", "  ", "\n", "▁", "é", "日本", "\t", "ing", ".", "1", "x", "\x00", "😀", "   "]
    return ["".join(rng.choice(chars) for _ in range(rng.randint(1, 25))) for _ in range(800)]


def test_encode_equals_plain_viterbi_and_round_trips(coder):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_path())
    vocab = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    assert coder.cut_blanks and coder.cut_lines
    for t in [x for x in edge_texts() if x][:30] + fuzz():
        ids = np.frombuffer(coder.encode(t), "<i4")
        assert coder.decode(ids) == t, repr(t)
        if "▁" not in t and len(t) < 3000:
            assert ids.tolist() == plain_viterbi(coder, vocab, "▁" + t.replace(" ", "▁")), repr(t)


def test_whole_text_form_gives_the_same_ids(coder):
    whole = pieces.PieceCoder(pieces.vocabulary_path())
    whole.cut_blanks = False
    lines = pieces.PieceCoder(pieces.vocabulary_path())
    lines.cut_lines = False
    for t in fuzz() + [prose(random.Random(1), 300)]:
        assert coder.encode(t) == whole.encode(t) == lines.encode(t), repr(t)


def test_full_cache_changes_nothing(coder, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_CHUNKS", 3)
    small = pieces.PieceCoder(pieces.vocabulary_path())
    for t in fuzz()[:50]:
        assert small.encode(t) == coder.encode(t)
    assert len(small.cache) <= 3


def test_piece_query(spark, edge_docs, empty_docs, table, coder):
    folder = table(documents=edge_docs)
    out = {r.doc_id: r for r in pieces.op7_piece_viterbi(spark, folder).collect()}
    for r in edge_docs.collect():
        x = out[r.doc_id]
        want = None if r.text is None else np.frombuffer(coder.encode(r.text), "<i4").tolist()
        assert x.ids == want and x.exact and x.n_pieces == len(want or [])
    back = pieces.decode_ids(pieces.encode_documents(edge_docs, pieces.vocabulary_path()), pieces.vocabulary_path())
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in edge_docs.collect()}
    assert pieces.encode_documents(empty_docs, pieces.vocabulary_path()).count() == 0


# ---- language ----------------------------------------------------------------

def plain_phrases(samples, text):
    n, at = 0, 0
    while at < len(text):
        size = 1
        if any(text[at] in s for s in samples):
            while at + size < len(text) and any(text[at:at + size + 1] in s for s in samples):
                size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_equal_brute_force():
    rng = random.Random(6)
    for _ in range(40):
        alphabet = "abc"[:rng.randint(1, 3)]
        samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 4))]
        root = language.suffix_automaton(samples)
        for _ in range(20):
            t = "".join(rng.choice(alphabet + "z") for _ in range(rng.randint(0, 40)))
            assert language.phrases(root, t) == plain_phrases(samples, t), (samples, t)


def test_phrases_of_many_texts_equal_brute_force(monkeypatch):
    rng = random.Random(7)
    word = lambda alphabet, most: "".join(rng.choice(alphabet) for _ in range(rng.randint(0, most)))
    for alphabets in (("ab", "bcd"), ("a", "é𐐨日", "ab")):
        samples = {f"l{i}": [word(a, 40) + a for _ in range(3)] for i, a in enumerate(alphabets)}
        texts = [word("abcdé𐐨日\ue000", 30) for _ in range(150)] + ["", "abcd" * 200, "𐐩", "a"]
        want = [[plain_phrases(samples[m], t) for m in sorted(samples)] for t in texts]
        assert language.Identifier(samples).phrases(texts) == want
        assert language.Identifier(samples, most_cells=10).phrases(texts) == want       # no tables
        assert language.Identifier(samples, most_cells=400).phrases(texts) == want
    model = language.Identifier({"en": ["the cat sat on the mat"], "de": ["die katze sitzt"]})
    texts = ["a cat", None, "12", "die matte", "the cat"] * 40 + ["the cat sat " * 500]
    one_by_one = [model.predict(t) for t in texts]
    by_itself, plain = [], language.phrases
    monkeypatch.setattr(language, "phrases", lambda root, t: by_itself.append(len(t)) or plain(root, t))
    assert model.predict_all(texts) == one_by_one
    assert by_itself == [5999] * 2         # only the one that is far longer than the others


def test_slices_hold_whole_texts():
    found = list(language._slices(pa.array(["a" * language.SLICE_CHARS, None, "b", "c" * language.SLICE_CHARS, "d"])))
    assert found == [(0, 2), (2, 1), (3, 1), (4, 1)]
    assert list(language._slices(pa.array([], pa.string()))) == []
    assert list(language._slices(pa.array([None, "", None]))) == [(0, 3)]


def test_letters():
    assert language.letters("The&&& É1 naïve.\n\n 日本 ***") == "the é naïve 日本"


def test_language_query(spark, edge_docs, empty_docs, table):
    folder = table(documents=edge_docs)
    out = {r.doc_id: r for r in language.op8_cross_parsing(spark, folder).collect()}
    for r in edge_docs.collect():
        x = out[r.doc_id]
        assert x.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        letters = any(c.isalpha() for c in r.text or "")
        assert (x.lang_pred == "und") == (not letters) and 0 <= x.score <= 1
    samples = language.learning_samples(edge_docs)
    learned = {t for s in samples.values() for t in s}
    held = {r.text for r in edge_docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    others = {r.text for r in edge_docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    assert not learned & (held - others) and None not in samples
    assert language.identify(edge_docs, {}).filter("lang_pred <> 'und'").count() == 0
    assert language.learning_samples(empty_docs) == {}
    nulls = spark.createDataFrame([(None, "abc", "en", "s", 0, "", "", "", "")], DOCS)
    assert language.learning_samples(nulls) == {}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = language.op8_cross_parsing(spark, "/root/testdata/sf0.01").filter("held_out").join(docs, "doc_id")
    right = got.filter(F.col("lang") == F.col("lang_pred")).count()
    assert right / got.filter("lang IS NOT NULL").count() > 0.97


def test_copies_do_not_fill_the_learning_sample(spark):
    from aisle.llm.queries import share_code
    share_code(spark)
    rng = random.Random(9)
    texts = [prose(rng, 30) for _ in range(200)]
    ids = [i for i in range(20000) if zlib.crc32(str(i).encode()) % 3 != 1]
    one = spark.createDataFrame([(t,) for t in texts], "text string")
    first = one.orderBy(F.xxhash64("text", F.lit(8))).first()["text"]
    rows = [(d, t, "en") for d, t in zip(ids, [first] * 1000 + texts + ["12 !", "..."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    learned = language.learning_samples(docs)["en"]
    assert learned[0] == first and sorted(learned) == sorted(set(texts))      # all fit, each once
    few = language.learning_samples(docs, rows=2, chars=1000)["en"]
    assert few == learned[:len(few)] and 2000 - 1000 < sum(map(len, few)) <= 2000


@pytest.mark.parametrize("text", ["½", "² ³", "Ⅷ", "123 456", "٣", "_ - .", "", None])
def test_numbers_are_no_letters(text):
    model = language.Identifier({"en": ["the cat sat"], "de": ["die katze sitzt"]})
    assert model.predict(text) == ("und", 0.0)
    assert model.predict((text or "") + " the cat")[0] == "en"


def test_sample_by_levels_equals_sample_at_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").repartition(23, "doc_id")
    at_once = language.learning_samples(docs, rows=5, chars=800)
    assert len(at_once) > 1
    for fan_in in (2, 3, 7):
        assert language.learning_samples(docs, rows=5, chars=800, fan_in=fan_in) == at_once
