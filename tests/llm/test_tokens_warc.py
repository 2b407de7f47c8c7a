import base64
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from aisle.llm import tokens, warc
from tests.llm.conftest import edge_texts

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("digest", T.StringType())])


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.vocabulary_path())


def test_pieces_give_the_ids_of_the_whole_text():
    lib, enc = library(), tokens.Encoder(tokens.vocabulary_path())
    rng = random.Random(1)
    chars = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "é", "1", ".", " ", " ", "\x1c", "\x85", "日", "!", "\r"]
    texts = [t or "" for t in edge_texts()] + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    end = "<|endoftext|>"
    texts += [end, end + end, f"a{end}b", f"a {end} b\n{end}", f" {end}\n\n", "<|endoftext|", f"one\n{end[:-1]} {end}two  three", "<|end oftext|>"]
    got = enc.encode(texts)
    assert np.frombuffer(enc.encode([end])[0], "<u4").tolist() == [50256]
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_full_cache_changes_nothing(monkeypatch):
    texts = [t for t in edge_texts() if t]
    want = tokens.Encoder(tokens.vocabulary_path()).encode(texts)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    monkeypatch.setattr(tokens, "CALL_WORDS", 7)
    enc = tokens.Encoder(tokens.vocabulary_path())
    assert [enc.encode([t])[0] for t in texts] == want and len(enc.cache) <= 10


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 64, 65, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n % 2 else 50257, n, dtype=np.uint64).astype("<u4")
    assert (tokens.from_planes(tokens.to_planes(ids, kind), n, kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip(kind):
    rng, out = np.random.default_rng(5), io.BytesIO()
    docs = [(None if i == 3 else i * 7, rng.integers(0, 50257, n).astype("<u4").tobytes()) for i, n in enumerate([1, 0, 300, 5, 64, 1, 999])]
    w = tokens.PlaneWriter(out, kind, chunk=64)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    raw = out.getvalue()
    r = tokens.PlaneReader(io.BytesIO(raw), len(raw), chunk=64)
    at = 0
    for (d, ids), got in zip(docs, r.documents()):
        assert got == (d, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert (np.concatenate([r.read_chunk(i) for i in range(len(r.index))]).tobytes()) == b"".join(x for _, x in docs)


def test_token_query(spark, edge_docs, empty_docs, table):
    lib, at = library(), 0
    out = {r.doc_id: r for r in tokens.op10_bit_planes(spark, table(documents=edge_docs)).collect()}
    for r in sorted(edge_docs.collect(), key=lambda r: r.doc_id):
        ids = np.array([*lib.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        x = out[r.doc_id]
        assert (x.start, x.n_tokens, x.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    folder = tokens.new_folder(spark, "planes")
    assert tokens.read_ids(tokens.write_ids(empty_docs, folder, tokens.vocabulary_path()), folder).count() == 0


def pages():
    rng = random.Random(2)
    rows = [(i, f"https://www.A.example.com/p/{i % 7}?q={i % 3}", f"<p>é{rng.randint(0, 30)}</p>" * (i % 5), "x") for i in range(200)]
    rows += [(500, None, None, "x"), (501, "http://[bad", "", "x"), (502, "http://a.b/ü \r\nInjected: 1", "q\r\n\r\nWARC/1.1\r\n", "x"),
             (None, "http://n.n/", "solo", "x"), (None, "http://n.n/", "<p>", "x"), (503, "u", "<p>", "x"),
             (600, "http://r.r/", "same", "x"), (600, "http://r.r/", "same", "x"), (601, "http://l.l", "long " * 50000, "x")]
    return rows


def test_warc_query(spark, table, edge_docs):
    rows = pages()
    out = warc.op4_warc_history(spark, table(pages=spark.createDataFrame(rows, PAGES).repartition(4))).collect()
    keeper = {}
    for p, _, h, _ in rows:
        if p is not None:
            keeper[h or ""] = max(p, keeper.get(h or "", -1))
    want = []
    for p, _, h, _ in rows:
        b = (h or "").encode()
        best = keeper.get(h or "")
        refers = best if best is not None and best != p else None
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if refers is not None else "response", refers))
    order = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r)[:5] for r in out], key=order) == sorted(want, key=order)
    assert sorted(r.history_no for r in out) == list(range(1, len(rows) + 1))
    history = sorted(out, key=lambda r: r.history_no)
    keys = [(r.url_key, r.captured, -1 if r.page_id is None else r.page_id) for r in history]
    assert keys == sorted(keys)
    assert "com,example,a)/p/0?q=0" in {r.url_key for r in out}


def test_threshold_and_empty(spark, edge_docs):
    df = spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcdef", ""), (4, "u", "abcdef", "")], PAGES)
    folder = warc.new_folder(spark, "warc")
    got = {r.page_id: r.record_type for r in warc.capture_runs(warc.write_archives(df, folder, 5), folder).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.merge_runs(warc.capture_runs(warc.write_archives(df.limit(0), folder), folder)).count() == 0


def test_archive_is_standard_gzip_and_truncation_is_an_error():
    data = warc.gzip_member(warc.format_record(1, "http://a/", b"x", None)) + warc.gzip_member(warc.format_record(2, "http://b/", b"x", 1))
    plain = gzip.decompress(data)
    assert plain.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: " + warc.record_id(1).encode() in plain
    assert [r[3] for r in warc.read_archive(io.BytesIO(data), "f")] == [1, 2]
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-9]), "f"))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 33])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(rng.randint(0, 50) for _ in range(rng.choice([0, 1, 30]))) for _ in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)
