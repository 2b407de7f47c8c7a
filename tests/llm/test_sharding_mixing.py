import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from aisle.llm import mixing, sharding
from tests.llm.conftest import DOCS, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_shards_equal_brute_force(spark, edge_docs, table):
    got = {r.doc_id: r for r in sharding.op3_byte_shards(spark, table(documents=edge_docs)).collect()}
    rows = sorted(edge_docs.collect(), key=lambda r: r.doc_id)
    total, before, slots = sum(len((r.text or "").encode()) + 1 for r in rows), 0, defaultdict(int)
    assert len(got) == len(rows)
    for r in rows:
        raw = (r.text or "").encode()
        shard = min(15, before * 16 // total)
        x = got[r.doc_id]
        assert (x.size, x.text_crc32, x.shard, x.slot) == (len(raw) + 1, zlib.crc32(raw), shard, slots[shard])
        assert x.law == "bytes" and x.grown_shard is None
        slots[shard] += 1
        before += len(raw) + 1


def test_shards_of_ties_nulls_and_nothing(spark, empty_docs):
    assert sharding.byte_shards(empty_docs).count() == 0
    rows = [(None, "a", "en", "s", 1, "", "", "", "")] * 2 + [(5, "bb", None, None, 2, "", "", "", "")] * 40
    out = sharding.byte_shards(spark.createDataFrame(rows, DOCS), 4).collect()
    assert len(out) == 42
    for k in range(4):
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))
    assert {r.shard for r in out if r.doc_id is None} == {0}


def _targets(sizes: dict) -> dict:
    """Reshare the excess by weight, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), dict.fromkeys(names, 0.0), set()
    for _ in range(len(names) + 1):
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        over = [s for s in free if target[s] > 3 * sizes[s]]
        for s in over:
            target[s] = 3 * sizes[s]
        capped |= set(over)
        if not over:
            break
    return target


def test_mix_targets_and_takes(spark, edge_docs, table):
    folder = table(documents=edge_docs)
    out = mixing.op5_curriculum_mix(spark, folder).collect()
    again = mixing.op5_curriculum_mix(spark, folder).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    docs = {r.doc_id: r for r in edge_docs.collect()}
    sizes, most, used = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs.values():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        most[r.source] = max(most[r.source], n)
    want = _targets(sizes)
    for r in out:
        s = docs[r.doc_id].source
        assert r.size == len(WORD.findall(docs[r.doc_id].text or ""))
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert (r.first_position is None) == (r.taken == 0)
        used[s] += r.taken
    for s in sizes:
        assert abs(used[s] - want[s]) <= most[s] / 2 + 1


def test_schedule_inverse(spark):
    for knots in (*mixing.SCHEDULES, ((0.0, 0.0), (0.3, 2.0), (1.0, 0.5))):
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))

        def used(t):
            s = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                x = min(max(t - t0, 0.0), t1 - t0)
                s += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            return s / area
        rows = spark.range(0, 21).select((F.col("id") / 20).alias("u")).select(
            "u", mixing.invert_schedule(F.col("u"), knots).alias("t")).collect()
        assert all(abs(used(r.t) - r.u) < 1e-9 for r in rows)


def test_mix_repeats_rows_in_order_and_keeps_columns(spark, edge_docs, empty_docs):
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    counts = {r.doc_id: r.copies for r in mixing.taken(edge_docs).collect()}
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.doc_id] += 1
    assert got == {k: v for k, v in counts.items() if v}
    assert mixing.mix(empty_docs).count() == 0
    twins = spark.createDataFrame(rows_of(["a b c"] * 9) + rows_of([None, " "]), DOCS)
    assert mixing.taken(twins).count() == 11


def test_native_plans(edge_docs):
    for df in (sharding.byte_shards(edge_docs), mixing.mix(edge_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_ranks_are_the_places_in_the_mix(spark, edge_docs, table):
    """Every copy's rank against the sorted mix, and read back from its files."""
    folder = table(documents=edge_docs)
    mixed = [r.doc_id for r in mixing.mix(spark.read.parquet(f"{folder}/documents.parquet")).collect()]
    at = defaultdict(list)
    for r in mixing.op5_curriculum_mix(spark, folder).collect():
        assert (r.training_ranks is None) == (r.taken == 0)
        at[r.doc_id] += [int(k) for k in (r.training_ranks or "").split(",") if k]
    assert sorted(k for v in at.values() for k in v) == list(range(len(mixed)))
    assert all(mixed[k] == d for d, v in at.items() for k in v)
    mixing.mix(edge_docs).write.option("maxRecordsPerFile", 7).parquet(f"{folder}/mixed")
    stored = mixing.in_written_order(spark.read.parquet(f"{folder}/mixed")).collect()
    assert sorted(r.training_rank for r in stored) == list(range(len(mixed)))
    assert all(mixed[r.training_rank] == r.doc_id for r in stored)
    assert {r.training_rank for r in mixing.in_written_order(edge_docs).collect()} == {None}


def test_prefix_sums_equal_brute_force(spark):
    import random
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b"]), rng.randrange(5), i, rng.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, b int, i int, v long").repartition(4)
    got = sharding.prefix_sums(df, ["g"], "b", [F.col("i")], {"s": F.col("v"), "k": F.lit(1)}).collect()
    for r in got:
        before = [x for x in rows if x[0] == r.g and (x[1], x[2]) < (r.b, r.i)]
        assert (r.s, r.k) == (sum(x[3] for x in before), len(before))
        assert (r.s_total, r.k_total) == (sum(x[3] for x in rows if x[0] == r.g), sum(x[0] == r.g for x in rows))
