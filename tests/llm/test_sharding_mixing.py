"""Shard table against a plain fill; mixing against plain loops."""

from collections import Counter, defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from larder.llm import mixing, sharding


def plain_fill(shards, slots):
    orders = []
    for name in shards:
        begin, step = sharding.preference(name, slots)
        orders.append(iter([(begin + j * step) % slots for j in range(slots)]))
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[s] for s in range(slots)]


@pytest.mark.parametrize("shards,slots", [(1, 2), (3, 7), (5, 101), (12, 499)])
def test_table_equals_plain_fill(shards, slots):
    names = [f"n{i}" for i in range(shards)]
    table = sharding.fill(names, slots)
    assert table == plain_fill(names, slots)
    sizes = Counter(table).values()
    assert max(sizes) - min(sizes) <= 1


def test_few_keys_move():
    names = [f"n{i}" for i in range(20)]
    before, after = sharding.fill(names, 4099), sharding.fill(names[:-1], 4099)
    stayed = sum(a == b for a, b in zip(before, after))
    assert stayed > 0.8 * 4099


@pytest.mark.parametrize("shards,slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 1 + ["b", "c"], 3)])
def test_bad_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.fill(shards, slots)


def test_place(spark, edges, nothing):
    rows, docs = edges
    names = ["x", "y", "z"]
    found = sharding.place(docs, "doc_id", names, 101)
    assert found.columns == [*docs.columns, "slot", "shard"]
    table = sharding.fill(names, 101)
    got = Counter((r.doc_id, r.slot, r.shard) for r in found.collect())
    want = Counter()
    for key, *_ in rows:
        slot = int(md5(("" if key is None else str(key)).encode()).hexdigest()[:15], 16) % 101
        want[(key, slot, names[table[slot]])] += 1
    assert got == want
    assert sharding.place(nothing, "doc_id", names, 101).count() == 0
    with pytest.raises(ValueError):
        sharding.place(docs.withColumn("Shard", F.lit(1)), "doc_id", names, 101)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan


def plain_targets(sizes, weights, share, most):
    """Shares by weight; what exceeds a cap goes to the others, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    cap = {s: most * sizes[s] for s in order}
    full, left = set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        if not free:
            return cap
        rest = left - sum(cap[s] for s in full)
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap[s]}
        if not over:
            return {s: cap[s] if s in full else level * weight[s] for s in order}
        full |= over


def plain_copies(rows, targets, sizes, seed=0):
    by_source = defaultdict(list)
    for key, text, _, source, _ in rows:
        digest = md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
        by_source[source].append((len((text or "").encode().split()), digest, key))
    found = Counter()
    for source, items in by_source.items():
        each = int((targets[source] / sizes[source] if sizes[source] else 0) * 2**32)
        name = f"{seed}/{str(source is not None).lower()}/{source or ''}"
        at = int(md5(name.encode()).hexdigest()[:8], 16)
        for size, _, key in sorted(items, key=lambda x: x[:2]):
            found[(key, size, source, (at + each) // 2**32 - at // 2**32)] += 1
            at += each
    return found


@pytest.mark.parametrize("weights", [(3, 1, 2), (1,), (1, 50)])
def test_mix_equals_plain_loop(spark, edges, weights):
    rows, docs = edges
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").encode().split())
    targets = plain_targets(sizes, weights, 1.5, 2.0)
    found = mixing.copies(docs, "doc_id", "text", "source", weights, carry=["source"]).collect()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.copies <= 2
    assert Counter((r.doc_id, r.size, r.source, r.copies) for r in found) == plain_copies(rows, targets, sizes)
    for source, size in sizes.items():
        taken = sum(r.copies * r.size for r in found if r.source == source)
        longest = max((r.size for r in found if r.source == source), default=0)
        assert abs(taken - targets[source]) <= 2 * longest


def test_mixed_rows(spark, edges, nothing):
    rows, docs = edges
    out = mixing.mixed(docs, weights=(3, 1, 2))
    assert out.columns == docs.columns
    taken = mixing.copies(docs, "doc_id", "text", "source", carry=["text"]).collect()
    want = Counter()
    for r in taken:
        want[(r.doc_id, r.text)] += r.copies
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +want
    again = mixing.mixed(docs.repartition(7))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, out.collect()))
    assert mixing.mixed(nothing).count() == 0


def test_hot_source_and_size_are_spread(spark):
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("hot").alias("source")
    )
    found = mixing.copies(docs, "doc_id", "text", "source", share=0.5).where("copies > 0")
    assert found.count() in (10000, 10001)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_is_the_same_for_shuffled_rows_that_differ_in_other_columns(spark):
    rows = [(1, "a b c", f"l{i}", "s", i if i % 2 else None) for i in range(9)] + [(2, "d e", "en", "s", 1)]
    rows += [(3, "f", None, "t", 4), (3, "f", "4", "t", None)]
    layout = "doc_id long, text string, lang string, source string, n_chars long"
    found = set()
    for turn in range(6):
        df = spark.createDataFrame(rows[turn:] + rows[:turn], layout).repartition(1 + turn % 3)
        found.add(tuple(sorted(map(tuple, mixing.mixed(df, weights=(3, 1, 2), share=1.2, most=2.0).collect()), key=repr)))
    assert len(found) == 1
