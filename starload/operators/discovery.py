"""Model discovery from the data (Q4, D9, D11, D12): inclusion dependencies,
minimal keys, minimal functional dependencies, and what follows for the choice
of a fact table.

What reaches the driver is one number per set of columns, never a value: the
searches are bounded by the schema, the rows stay in hash aggregates with
map-side combine, so a value held by a third of the rows is one partial row per
task.  Columns of arrays, structs or maps take no part.
"""

from __future__ import annotations

import gc
from collections.abc import Iterable, Mapping, Sequence
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType)

#: Values of one kind are compared with each other, as this type.
KINDS: dict[str, tuple[str, tuple[type[DataType], ...]]] = {
    "integer": ("bigint", (ByteType, ShortType, IntegerType, LongType)),
    "number": ("double", (FloatType, DoubleType, DecimalType)),
    "text": ("string", (StringType,)),
    "time": ("timestamp_ntz", (DateType, TimestampType, TimestampNTZType)),
    "boolean": ("boolean", (BooleanType,)),
}
NUMERIC = ("integer", "number")
BITS = 60            # columns in one mask word
SAMPLE_ROWS = 20_000
SAMPLE_SHARE = 32    # of the rows, one in so many in the largest sample
SETS_PER_JOB = 64
DIGESTS_PER_JOB = 1 << 25
VALUES_PER_CLASS = 20


def kind_of(data_type: DataType) -> str | None:
    return next((k for k, (_, types) in KINDS.items() if isinstance(data_type, types)), None)


def stem(name: str) -> str:
    """A column's name without its table prefix: ``o_custkey`` -> ``custkey``."""
    return name.split("_", 1)[1] if "_" in name else name


def _catalogue(tables: Mapping[str, DataFrame]) -> list[tuple[int, str, str, str]]:
    """(id, table, column, kind) of every comparable column."""
    found = [(t, f.name, kind_of(f.dataType)) for t, df in tables.items() for f in df.schema.fields]
    return [(i, *c) for i, c in enumerate(c for c in found if c[2])]


def _column_sets(tables: Mapping[str, DataFrame], columns: Sequence[tuple[int, str, str, str]],
                 kind: str) -> DataFrame:
    """(members, n): the sets of columns (ids) that share a value, and how many
    distinct values each exact set has.  One shuffle: a value's columns are bits
    that the map side already combines."""
    own = [c for c in columns if c[3] == kind]
    words = -(-len(own) // BITS)
    place = {c[0]: divmod(at, BITS) for at, c in enumerate(own)}
    values = None
    for table in dict.fromkeys(c[1] for c in own):
        cells = [F.struct(*[F.lit(1 << place[i][1] if place[i][0] == w else 0).cast("bigint").alias(f"w{w}")
                            for w in range(words)], F.col(f"`{c}`").cast(KINDS[kind][0]).alias("v"))
                 for i, t, c, _ in own if t == table]
        part = tables[table].select(F.inline(F.array(*cells)))
        values = part if values is None else values.unionByName(part)
    names = [f"w{w}" for w in range(words)]
    sets = (values.filter(F.col("v").isNotNull()).groupBy("v").agg(*[F.bit_or(w).alias(w) for w in names])
            .groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    member = [F.when(F.getbit(F.col(f"w{place[i][0]}"), F.lit(place[i][1])) == 1, F.lit(i)) for i, *_ in own]
    return sets.select(F.array_compact(F.array(*member)).alias("members"), "n")


def _filled(tables: Mapping[str, DataFrame], columns: Sequence[tuple[int, str, str, str]]) -> DataFrame:
    """(id, filled, rows): non-null values and rows of every column, one row per
    task in the shuffle."""
    out = None
    for table in dict.fromkeys(c[1] for c in columns):
        own = [c for c in columns if c[1] == table]
        wide = tables[table].agg(F.count(F.lit(1)).alias("rows"),
                                 *[F.count(F.col(f"`{c}`")).alias(f"f{i}") for i, _, c, _ in own])
        part = wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("id"), F.col(f"f{i}").alias("filled"), "rows")
                                              for i, *_ in own])))
        out = part if out is None else out.unionByName(part)
    return out


def inclusion_dependencies(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every ordered pair of columns of one kind, how many distinct values
    of the child occur in the parent, and the child's ranking of its parents.

    No pair is named in advance.  Every value is grouped once with the columns it
    occurs in; the distinct column sets, few whatever the rows, are then spread
    into pairs.  Parents that hold all of a child's values and are unique come
    first; among them names decide (``name_match``: equal without the table
    prefix), then the smaller parent.
    """
    columns = _catalogue(tables)
    sets = None
    for kind in dict.fromkeys(c[3] for c in columns):
        part = _column_sets(tables, columns, kind)
        sets = part if sets is None else sets.unionByName(part)
    both = (sets.select("n", "members", F.explode("members").alias("child"))
            .select("n", "child", F.explode("members").alias("parent"))
            .groupBy("child", "parent").agg(F.sum("n").alias("contained")))
    spark = both.sparkSession
    names = spark.createDataFrame([(*c, stem(c[2])) for c in columns],
                                  "id int, tab string, col string, kind string, stem string")
    # One row per column: every value of a column is contained in the column.
    distinct = both.filter(F.col("child") == F.col("parent")).select(
        F.col("child").alias("id"), F.col("contained").alias("values"))
    facts = (names.join(_filled(tables, columns), "id").join(distinct, "id", "left")
             .withColumn("values", F.coalesce("values", F.lit(0)))
             .withColumn("unique", (F.col("values") == F.col("rows")) & (F.col("rows") > 0)))
    c = facts.select([F.col(x).alias(f"c_{x}") for x in facts.columns])
    p = facts.select([F.col(x).alias(f"p_{x}") for x in facts.columns])
    pairs = (c.join(p, (F.col("c_kind") == F.col("p_kind")) & (F.col("c_id") != F.col("p_id")))
             .join(both, (F.col("c_id") == F.col("child")) & (F.col("p_id") == F.col("parent")), "left")
             .withColumn("contained", F.coalesce("contained", F.lit(0))))
    whole = (F.col("contained") == F.col("c_values")) & (F.col("c_values") > 0) & F.col("p_unique")
    same = F.col("c_stem") == F.col("p_stem")
    order = Window.partitionBy("c_id").orderBy(        # as many rows as there are columns
        whole.desc(), same.desc(), F.desc("contained"), F.asc("p_values"), F.asc("p_tab"), F.asc("p_col"))
    return pairs.select(
        F.col("c_tab").alias("child_table"), F.col("c_col").alias("child_column"),
        F.col("p_tab").alias("parent_table"), F.col("p_col").alias("parent_column"), F.col("c_kind").alias("kind"),
        F.col("c_values").alias("distinct_child"), "contained",
        F.try_divide(F.col("contained"), F.col("c_values")).cast("double").alias("ratio"),
        F.col("c_unique").alias("child_unique"), F.col("p_unique").alias("parent_unique"),
        same.alias("name_match"), F.row_number().over(order).cast("bigint").alias("rnk"))


def references(pairs: DataFrame) -> DataFrame:
    """The inferred foreign keys among the pairs of ``inclusion_dependencies``: all
    of a column's values lie in a unique column of another table that bears its
    name; the first such parent of each column."""
    fit = pairs.filter((F.col("contained") == F.col("distinct_child")) & (F.col("distinct_child") > 0)
                       & F.col("parent_unique") & F.col("name_match")
                       & (F.col("child_table") != F.col("parent_table")))
    child = Window.partitionBy("child_table", "child_column").orderBy("rnk")
    return (fit.withColumn("__first", F.row_number().over(child)).filter(F.col("__first") == 1)
            .select("child_table", "child_column", "parent_table", "parent_column"))


def fact_ranking(tables: Mapping[str, DataFrame], pairs: DataFrame | None = None) -> DataFrame:
    """Tables by how much they look like a fact: the references they make,
    fewest made to them, and their measures, that is numeric columns which are
    neither unique nor a reference.  All of it measured on the data."""
    pairs = inclusion_dependencies(tables) if pairs is None else pairs
    spark = pairs.sparkSession
    links = references(pairs)
    columns = _catalogue(tables)
    names = spark.createDataFrame([(t, c, k) for _, t, c, k in columns],
                                  "child_table string, child_column string, kind string")
    unique = pairs.groupBy("child_table", "child_column").agg(F.bool_or("child_unique").alias("child_unique"))
    marked = (names.join(unique, ["child_table", "child_column"], "left")
              .join(links.select("child_table", "child_column", "parent_table"),
                    ["child_table", "child_column"], "left"))
    linked = F.col("parent_table").isNotNull()
    measure = F.col("kind").isin(*NUMERIC) & ~linked & ~F.coalesce("child_unique", F.lit(False))
    own = marked.groupBy(F.col("child_table").alias("table_name")).agg(
        F.count_if(linked).alias("references"), F.count_if(measure).alias("measures"))
    inward = links.groupBy(F.col("parent_table").alias("table_name")).agg(F.count(F.lit(1)).alias("referenced_by"))
    counts = own.join(inward, "table_name", "left").select(
        "table_name", "references", F.coalesce("referenced_by", F.lit(0)).alias("referenced_by"), "measures")
    order = Window.orderBy(F.desc("references"), F.asc("referenced_by"), F.desc("measures"), F.asc("table_name"))
    return counts.withColumn("rnk", F.row_number().over(order).cast("bigint"))       # one row per table


# ---------------------------------------------------------------- keys and dependencies

ColumnSet = tuple[str, ...]


def _per_job(sets: Sequence[ColumnSet], rows: int | None) -> Iterable[list[ColumnSet]]:
    """The sets in portions: few to a job where the rows are many, and the shuffle
    files of one job are let go before the next, so the disk holds a few digests a
    row however many sets there are."""
    size = SETS_PER_JOB if rows is None else max(2, min(SETS_PER_JOB, DIGESTS_PER_JOB // max(rows, 1)))
    for at in range(0, len(sets), size):
        yield list(sets[at:at + size])


def _release(df: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffle files of a finished job."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def set_counts(df: DataFrame, sets: Iterable[ColumnSet],
               about: int | None = None) -> tuple[int, dict[ColumnSet, int]]:
    """Rows, and distinct rows of each set of columns (a null is a value), several
    sets to a job and one number each.  ``about``: the rows, where they are known.

    A row becomes (set, 128-bit digest) pairs, so whatever the columns' types one
    hash aggregate over three numbers counts them all.
    """
    sets, out = list(dict.fromkeys(sets)), {}

    def digest(s: ColumnSet, seed: int) -> Column:
        cells = [x for c in s for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
        return F.xxhash64(F.lit(seed), *cells) if seed else F.xxhash64(*reversed(cells), F.lit(1))

    rows = df.count() if not sets else 0
    for some in _per_job(sets, about):
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("s"), digest(x, 0).alias("a"), digest(x, 7).alias("b"))
            for i, x in enumerate(some)])))
        found = {r.s: r for r in pairs.groupBy("s", "a", "b").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("s").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")).collect()}
        rows = found[0].rows if found else 0
        out.update({x: found[i]["values"] if found else 0 for i, x in enumerate(some)})
        if len(some) < len(sets):
            _release(df)
    return rows, out


def _repeated(df: DataFrame, s: ColumnSet) -> bool:
    """Whether two rows agree on the columns, by their values."""
    cells = [F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(s)]
    return not df.groupBy(*cells).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def unique_sets(df: DataFrame, sets: Iterable[ColumnSet], about: int | None = None) -> set[ColumnSet]:
    """The sets of null-free columns on which no two rows agree, judged on all rows.

    Rows with different 64-bit digests differ, so a set whose digests are all
    different is unique and one number a row is all that is shuffled.  A digest met
    twice is looked up: the rows that have it are compared by value, and should they
    differ, all rows are.  For sets that samples did not refute: their digests hardly
    repeat, so they are dealt out by digest first and grouped only then; grouping
    before the shuffle would fill memory and save nothing.
    """
    sets, out = list(dict.fromkeys(sets)), set()
    for some in _per_job(sets, about):
        digest = {x: F.xxhash64(*[F.col(f"`{c}`") for c in x]) for x in some}
        one = df.select(F.inline(F.array(*[F.struct(F.lit(i).cast("short").alias("s"), digest[x].alias("h"))
                                           for i, x in enumerate(some)])))
        twice = {r.s: r.h for r in one.repartition("s", "h").groupBy("s", "h").agg(F.count(F.lit(1)).alias("n"))
                 .filter("n > 1").groupBy("s").agg(F.min("h").alias("h")).collect()}
        for i, x in enumerate(some):
            if i not in twice or not (_repeated(df.filter(digest[x] == F.lit(twice[i])), x) or _repeated(df, x)):
                out.add(x)
        _release(df)
    return out


class _Counter:
    """Row and distinct counts of a table and of bounded samples of it.

    A sample only ever refutes: two sampled rows that agree on a set of columns
    agree in the table as well.  It holds the rows whose value in one column of the
    set falls into one residue class, so rows that agree on the set are in it
    together and a witness survives with the sampling share; where that column has
    few values, the class is of whole rows.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], sample_rows: int):
        self.columns = list(columns)
        self.df = df.select([F.col(f"`{c}`") for c in columns])
        counts = self.df.agg(F.count(F.lit(1)).alias("rows"),
                             *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        self.rows = counts[0]
        self.filled = {c: counts[i + 1] == self.rows for i, c in enumerate(columns)}
        self.share = max(1, -(-self.rows // sample_rows))
        self._known: dict[ColumnSet, int] = {}
        self.distinct((c,) for c in columns)

    def distinct(self, sets: Iterable[ColumnSet]) -> dict[ColumnSet, int]:
        sets = list(sets)
        self._known.update(set_counts(self.df, [s for s in sets if s not in self._known], self.rows)[1])
        return {s: self._known[s] for s in sets}

    def _anchor(self, s: ColumnSet, share: int) -> str | None:
        best = max(s, key=lambda c: self._known[(c,)])
        return best if self._known[(best,)] >= VALUES_PER_CLASS * share else None

    def sampled(self, groups: Mapping[ColumnSet, Sequence[ColumnSet]],
                share: int | None = None) -> dict[ColumnSet, tuple[int, list[int]]]:
        """For each set, sampled rows and, in the same sample, the distinct rows of
        the sets named with it (which hold its columns)."""
        share = share or self.share
        if share == 1:
            return {s: (self.rows, [n for _, n in self.distinct(own).items()]) for s, own in groups.items()}
        by_anchor: dict[str | None, list[ColumnSet]] = {}
        for s in groups:
            by_anchor.setdefault(self._anchor(s, share), []).append(s)
        out = {}
        for anchor, mine in by_anchor.items():
            rows, counts = self._in_class(anchor, share, [x for s in mine for x in groups[s]])
            out.update({s: (rows, [counts[x] for x in groups[s]]) for s in mine})
        return out

    def _in_class(self, anchor: str | None, share: int, sets: Sequence[ColumnSet]) -> tuple[int, dict[ColumnSet, int]]:
        dealt = F.xxhash64(*[F.col(f"`{c}`") for c in ([anchor] if anchor else self.columns)])
        return set_counts(self.df.filter(F.pmod(dealt, F.lit(share)) == 0), sets, self.rows // share)

    def unique(self, sets: Sequence[ColumnSet]) -> list[ColumnSet]:
        """Those of the sets of null-free columns on which no two rows agree.

        Samples refute first: the bounded one, then a fixed share of the rows, so that
        sets with few witnesses do not reach the count of all rows.  A class of whole
        rows finds what many rows have in common, whatever class its value is in.
        """
        left = list(sets)
        for share in [self.share, *([SAMPLE_SHARE] if self.share > SAMPLE_SHARE else [])] if self.share > 1 else []:
            found = self.sampled({s: [s] for s in left}, share)
            left = [s for s in left if found[s][1][0] == found[s][0]]
        if left and self.share > 1:
            rows, counts = self._in_class(None, self.share, left)
            left = [s for s in left if counts[s] == rows]
        held = unique_sets(self.df, left, self.rows)
        return [s for s in left if s in held]


def _comparable(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return [f.name for f in df.schema.fields if kind_of(f.dataType) and (columns is None or f.name in columns)]


def minimal_keys(df: DataFrame, max_size: int = 3, columns: Sequence[str] | None = None,
                 sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Q4: all minimal unique column combinations of up to ``max_size`` columns,
    as (key_columns, n_columns, rows), columns in schema order.

    Level by level; a combination is left out when it holds a key (not minimal),
    when a column has a null, when the distinct counts of its columns multiply to
    less than the rows, and when two rows of a sample agree on it.  What remains is
    judged on all rows.  A table without rows has no keys.
    """
    columns = _comparable(df, columns)
    counter = _Counter(df, columns, sample_rows)
    usable = [c for c in columns if counter.filled[c]]
    keys: list[ColumnSet] = []
    size: dict[ColumnSet, int] = {}
    if counter.rows:
        size = counter.distinct((c,) for c in usable)
        keys = [s for s in size if size[s] == counter.rows]
    for k in range(2, max_size + 1 if counter.rows else 0):
        cells = [s for s in combinations(usable, k) if not any(set(key) <= set(s) for key in keys)]
        keys += counter.unique([s for s in cells if prod(size[(c,)] for c in s) >= counter.rows])
    return df.sparkSession.createDataFrame([(",".join(s), len(s), counter.rows) for s in keys],
                                           "key_columns string, n_columns int, rows long")


def _share_removed(df: DataFrame, determinant: ColumnSet, dependent: str, rows: int) -> DataFrame:
    """The least share of rows to take out for the dependency to hold."""
    per_value = df.groupBy(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(determinant)],
                           F.col(f"`{dependent}`").alias("a")).agg(F.count(F.lit(1)).alias("n"))
    kept = per_value.groupBy(*[f"x{i}" for i in range(len(determinant))]).agg(F.max("n").alias("n"))
    return kept.agg(F.sum("n").alias("kept")).select(
        F.lit(",".join(determinant)).alias("determinant"), F.lit(dependent).alias("dependent"),
        F.lit(len(determinant)).alias("n_columns"),
        (F.lit(rows) - F.col("kept")).cast("bigint").alias("violating_rows"),
        ((F.lit(rows) - F.col("kept")) / F.lit(rows)).cast("double").alias("error"))


def minimal_dependencies(df: DataFrame, max_size: int = 2, max_error: float = 0.05,
                         columns: Sequence[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All minimal functional dependencies with determinants of up to
    ``max_size`` columns, and the almost-dependencies of single columns: those
    that hold when at most ``max_error`` of the rows are taken out.  Columns:
    determinant, dependent, n_columns, violating_rows, error (0 where it holds).

    ``X -> a`` holds exactly when X and X with a have equally many distinct rows
    (a null is a value).  The lattice is searched by level: supersets of a
    determinant found are not minimal, a pair with a witness in the sample is
    refuted, and the rest is counted on all rows.  Each further distinct row of X
    with a costs a row at least, which bounds an error from below before it is
    measured.
    """
    columns = _comparable(df, columns)
    counter = _Counter(df, columns, sample_rows)
    spark = df.sparkSession
    schema = "determinant string, dependent string, n_columns int, violating_rows long, error double"
    if not counter.rows:
        return spark.createDataFrame([], schema)

    def joined(x: ColumnSet, a: str) -> ColumnSet:
        return tuple(c for c in columns if c in x or c == a)

    found: list[tuple[ColumnSet, str]] = []
    for k in range(1, max_size + 1):
        open_ = [(x, a) for x in combinations(columns, k) for a in columns if a not in x
                 and not any(b == a and set(y) <= set(x) for y, b in found)]
        dependents = {x: [a for y, a in open_ if y == x] for x, _ in open_}
        sampled = counter.sampled({x: [x, *[joined(x, a) for a in own]] for x, own in dependents.items()})
        open_ = [(x, a) for x, own in dependents.items()
                 for a, n in zip(own, sampled[x][1][1:]) if n == sampled[x][1][0]]
        counts = counter.distinct(s for x, a in open_ for s in (x, joined(x, a)))
        found += [(x, a) for x, a in open_ if counts[x] == counts[joined(x, a)]]
    out = spark.createDataFrame([(",".join(x), a, len(x), 0, 0.0) for x, a in found], schema)
    single = [((x,), a) for x in columns for a in columns if a != x and ((x,), a) not in found]
    counts = counter.distinct(s for x, a in single for s in (x, joined(x, a)))
    for x, a in single:
        if counts[joined(x, a)] - counts[x] <= max_error * counter.rows:
            near = _share_removed(counter.df, x, a, counter.rows)
            out = out.unionByName(near.filter(F.col("error") <= max_error))
    return out
