"""Discovery of inclusion dependencies, keys and dependencies against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starload.operators import discovery
from starload.operators.discovery import (fact_ranking, inclusion_dependencies, minimal_dependencies, minimal_keys,
                                          references, set_counts)


def _rows(n=600, seed=2):
    """A key of one, of two and of three columns, a derived column, a hot value."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = i // 100, i // 10 % 10, i % 10
        out.append((i, a * 10 + b, c, a, b, None if i % 3 == 0 else f"t{a}", "hot" if i % 3 else rng.choice("xyz"),
                    float(c * 2)))
    rng.shuffle(out)
    return out


SCHEMA = "id long, ab int, c int, a int, b int, name string, hot string, twice double"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(7)


def _distinct(rows, at):
    return len({tuple(r[i] for i in at) for r in rows})


def test_minimal_keys_equal_brute_force(table):
    rows, names = _rows(), [f.split()[0] for f in SCHEMA.split(", ")]
    whole = [i for i in range(len(names)) if all(r[i] is not None for r in rows)]
    want = []
    for k in (1, 2, 3):
        for s in combinations(whole, k):
            if _distinct(rows, s) == len(rows) and not any(set(w) <= set(s) for w in want):
                want.append(s)
    want = sorted(",".join(names[i] for i in s) for s in want)
    for sample_rows in (50, 20_000):                   # with and without a sample to refute by
        got = minimal_keys(table, sample_rows=sample_rows)
        assert sorted(r.key_columns for r in got.collect()) == want
    assert {"id", "ab,c", "c,a,b"} <= set(want)


def test_minimal_dependencies_equal_brute_force(table):
    rows, names = _rows(), [f.split()[0] for f in SCHEMA.split(", ")]

    def error(x, a):
        groups = {}
        for r in rows:
            groups.setdefault(tuple(r[i] for i in x), []).append(r[a])
        return len(rows) - sum(max(map(g.count, set(g))) for g in groups.values())

    want, holds = set(), []
    for k in (1, 2):
        for x in combinations(range(len(names)), k):
            for a in range(len(names)):
                if a in x or any(b == a and set(y) <= set(x) for y, b in holds):
                    continue
                wrong = error(x, a)
                if wrong == 0:
                    holds.append((x, a))
                if wrong == 0 or k == 1 and wrong <= 0.3 * len(rows):
                    want.add((",".join(names[i] for i in x), names[a], wrong))
    for sample_rows in (50, 20_000):
        got = minimal_dependencies(table, max_error=0.3, sample_rows=sample_rows).collect()
        assert {(r.determinant, r.dependent, r.violating_rows) for r in got} == want
        assert all(abs(r.error - r.violating_rows / len(rows)) < 1e-12 for r in got)
    assert {("c", "twice", 0), ("ab", "a", 0)} <= want and any(w for _, _, w in want)


def test_few_witnesses_refute_before_all_rows_are_counted(spark, monkeypatch):
    """(a, b) fails for 300 pairs of 40,000 rows, hardly ever in a sample of 50; few
    sets may be shuffled with all rows, and few of them at once."""
    df = spark.range(40_000).select("id", (F.col("id") % 20_000).alias("a"), (F.col("id") >= 20_300).cast("int").alias("b"),
                                    (F.col("id") >= 20_000).alias("c")).drop("id")
    judged, whole = [], discovery.unique_sets
    monkeypatch.setattr(discovery, "unique_sets",
                        lambda df, sets, about=None: judged.extend(sets) or whole(df, sets, about))
    assert [r.key_columns for r in minimal_keys(df, sample_rows=50).collect()] == ["a,c"]
    assert judged == [("a", "c")]
    assert [len(x) for x in discovery._per_job([("a",)] * 5, 36_000_000)] == [2, 2, 1]


def test_equal_digests_of_different_rows_do_not_refute_a_key(spark, monkeypatch):
    once = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "a int, b string")
    twice = once.union(once.filter("a = 3"))
    sets = [("a",), ("a", "b")]
    assert discovery.unique_sets(once, sets) == set(sets) and not discovery.unique_sets(twice, sets)
    monkeypatch.setattr(discovery.F, "xxhash64", lambda *cells: F.lit(7).cast("long"))
    assert discovery.unique_sets(once, sets) == set(sets) and not discovery.unique_sets(twice, sets)


def test_counts_treat_a_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (2, "x")], "a int, b string")
    assert set_counts(df, [("a",), ("b",), ("a", "b")]) == (4, {("a",): 2, ("b",): 2, ("a", "b"): 3})


def test_empty_tables_have_no_keys_and_no_dependencies(table):
    assert minimal_keys(table.limit(0)).collect() == []
    assert minimal_dependencies(table.limit(0)).collect() == []


@pytest.fixture(scope="module")
def star(spark):
    dim = spark.createDataFrame([(i, f"n{i}", i % 4) for i in range(40)], "d_key long, d_name string, d_level int")
    other = spark.createDataFrame([(i, i * 1.5) for i in range(60)], "o_id int, o_value double")
    fact = spark.createDataFrame([(i % 40 if i % 9 else None, 7 if i % 3 else i % 60, i % 5, float(i)) for i in range(900)],
                                 "f_key long, f_okey short, f_count int, f_amount double")
    return {"dim": dim, "other": other, "fact": fact}


def test_inclusion_dependencies_equal_brute_force(star):
    kinds = {"bigint": "i", "int": "i", "smallint": "i", "double": "n", "string": "t"}
    columns = [(t, c, kinds[kind], [r[0] for r in df.select(c).collect()])
               for t, df in star.items() for c, kind in df.dtypes]
    want = set()
    for t, c, k, v in columns:
        for t2, c2, k2, v2 in columns:
            if k == k2 and (t, c) != (t2, c2):
                values = set(v) - {None}
                want.add((t, c, t2, c2, len(values), len(values & set(v2)), len(set(v2) - {None}) == len(v2)))
    got = inclusion_dependencies(star).collect()
    assert {(r.child_table, r.child_column, r.parent_table, r.parent_column, r.distinct_child, r.contained,
             r.parent_unique) for r in got} == want and len(got) == len(want)
    best = {(r.child_table, r.child_column): (r.parent_table, r.parent_column) for r in got if r.rnk == 1}
    assert best["fact", "f_key"] == ("dim", "d_key")             # other.o_id holds its values, too; the name decides


def test_references_and_fact_ranking(star):
    pairs = inclusion_dependencies(star)
    assert [tuple(r) for r in references(pairs).collect()] == [("fact", "f_key", "dim", "d_key")]
    ranked = {r.table_name: (r.references, r.referenced_by, r.measures, r.rnk) for r in fact_ranking(star).collect()}
    assert ranked["fact"] == (1, 0, 2, 1) and ranked["dim"][1] == 1


def test_more_columns_than_one_mask_word(spark):
    """Seventy columns of one kind: the masks have two words."""
    df = spark.range(50).selectExpr(*[f"id + {i % 3} as c{i}" for i in range(70)])
    got = {(r.child_column, r.parent_column): r.contained for r in inclusion_dependencies({"wide": df}).collect()}
    assert len(got) == 70 * 69
    assert got["c0", "c69"] == 50 and got["c0", "c1"] == 49 and got["c62", "c1"] == 49 and got["c62", "c65"] == 50


def test_values_are_combined_before_the_one_shuffle(star):
    from starload.operators.discovery import _catalogue, _column_sets

    plan = _column_sets(star, _catalogue(star), "integer")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2                            # by value, then the few column sets
    assert "partial_bit_or" in plan and "SortAggregate" not in plan and "Python" not in plan
