"""Entity resolution of source rows against candidates: a cascade with ambiguity detection.

1. by global id: one candidate matches, several are ambiguous;
2. else by inventory number: if the source repeats the number, exactly one candidate of equal name
   and within the radius; otherwise a single candidate at any distance, or within the radius the
   only one of equal name, or the only one;
3. else by equal name within the radius: one matches, several are ambiguous;
4. else the row is new.

Rows don't influence each other, and a row decided by a stage takes no part in later ones. No stage
joins the rows of a number or name with all its candidates: candidates are counted once for each
number, and those within the radius are found through grid cells (`near`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import distance
from .materialize import cut_lineage, spread

RADIUS_M = 25.0


#: Cells of the first step of `near` across a radius, and the cells about a point's own that lie within the radius wherever in it the point is.
CELLS = 4
_SURE = [(i, j) for i in range(-CELLS, CELLS + 1) for j in range(-CELLS, CELLS + 1) if (abs(i) + 1) ** 2 + (abs(j) + 1) ** 2 < CELLS**2]


def near(rows: DataFrame, candidates: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """(record_number, n, one) for rows (record_number, keys, x, y) with candidates (candidate_id, keys, cx, cy) of equal keys within the radius.

    n is 1, with the candidate and its distance d in `one`, or 2 for several, without. First, small
    cells are counted, and rows whose own and adjoining cells hold several candidates are done; so
    crowds of rows and candidates in one place are never paired. The others meet the candidates of the
    nine cells of the radius' width about them.
    """
    rows = rows.select("record_number", *keys, "x", "y").where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    candidates = candidates.select("candidate_id", *keys, "cx", "cy").where("cx is not null and cy is not null and not isnan(cx) and not isnan(cy)")

    def cell(c: str, width: float) -> Column:
        return F.floor(F.col(c) / width).cast("long")

    def around(i: str, j: str, offsets: list[tuple[int, int]]) -> Column:
        """Cells at the offsets about a cell; as text, which is one expression to build instead of hundreds."""
        return F.expr(f"transform(array({', '.join(f'named_struct(\'a\', {a}L, \'b\', {b}L)' for a, b in offsets)}), o -> named_struct('i', {i} + o.a, 'j', {j} + o.b))")

    small = radius / CELLS
    held = candidates.groupBy(*keys, cell("cx", small).alias("ci"), cell("cy", small).alias("cj")).agg(F.count("*").alias("n"))
    # A few numbers a cell fill no partition by their size, but each makes many rows.
    held = spread(held, *keys, "ci", "cj").select(*keys, "n", F.explode(around("ci", "cj", _SURE)).alias("p"))
    crowded = held.groupBy(*keys, F.col("p.i").alias("i"), F.col("p.j").alias("j")).agg(F.sum("n").alias("n")).where("n > 1").drop("n").withColumn("crowded", F.lit(True))
    placed = rows.withColumn("i", cell("x", small)).withColumn("j", cell("y", small)).join(crowded, [*keys, "i", "j"], "left").drop("i", "j")
    placed = placed.withColumn("ri", cell("x", radius)).withColumn("rj", cell("y", radius))
    nine = around("ri", "rj", [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    # Rows in a crowd go on with one probe that meets nothing.
    nowhere = F.array(F.struct(F.lit(None).cast("long").alias("i"), F.lit(None).cast("long").alias("j")))
    probes = placed.select("record_number", *keys, "x", "y", "crowded", F.explode(F.when(F.col("crowded"), nowhere).otherwise(nine)).alias("p")).select("record_number", *keys, "x", "y", "crowded", "p.i", "p.j")
    cells = candidates.withColumn("i", cell("cx", radius)).withColumn("j", cell("cy", radius))
    met = probes.join(cells, [*keys, "i", "j"], "left").withColumn("d", distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")))
    close = F.col("d") <= radius
    counted = met.groupBy("record_number").agg(F.count_if(close).alias("n"), F.min(F.when(close, F.struct("candidate_id", "d"))).alias("one"), F.max("crowded").alias("crowded")).where("n > 0 or crowded")
    return counted.select("record_number", F.when(F.col("crowded"), F.lit(2)).otherwise(F.least("n", F.lit(2))).alias("n"), F.when(F.col("n") == 1, F.col("one")).alias("one"))


def match_cascade(rows: DataFrame, candidates: DataFrame, radius: float = RADIUS_M, source_counts: DataFrame | None = None) -> DataFrame:
    """`rows` (record_number, globalid, nr, name_norm, x, y) against `candidates` (candidate_id, globalid, nr, name_norm, x, y).

    Gives (record_number, status, strategy, candidate_id, distance_m, issue): matched, unresolved or
    new. Blank and null keys match nothing. A candidate may have several rows (one for each global id).
    `source_counts` (nr, source_nr) tells how often the source has a number; without it `rows` are counted.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    # Both sides are asked many times; what they are made of is computed once.
    rows = cut_lineage(rows.select("record_number", "globalid", "nr", "name_norm", "x", "y"))
    candidates = cut_lineage(candidates.select("candidate_id", "globalid", "nr", "name_norm", "x", "y"))
    counted = source_counts if source_counts is not None else rows.where(~blank("nr")).groupBy("nr").agg(F.count("*").alias("source_nr"))
    people = candidates.select("candidate_id", "nr", "name_norm", "x", "y").distinct()
    cand = people.select("candidate_id", F.col("nr").alias("c_nr"), F.col("name_norm").alias("c_name"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    apart = distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"))

    # Stage 1.
    by_id = rows.where(~blank("globalid")).select("record_number", F.col("globalid").alias("g"), "x", "y")
    ids = candidates.where(~blank("globalid")).select(F.col("candidate_id"), F.col("globalid").alias("g"), F.col("x").alias("cx"), F.col("y").alias("cy")).distinct()
    hits = by_id.join(ids, "g").groupBy("record_number").agg(F.count("*").alias("n"), F.min(F.struct("candidate_id", apart.alias("d"))).alias("c"))
    first = hits.select(
        "record_number",
        F.when(F.col("n") == 1, "matched").otherwise("unresolved").alias("status"),
        F.when(F.col("n") == 1, "globalid").alias("strategy"),
        F.when(F.col("n") == 1, F.col("c.candidate_id")).alias("candidate_id"),
        F.when(F.col("n") == 1, F.col("c.d")).alias("distance_m"),
        F.when(F.col("n") > 1, "GLOBALID_AMBIGUOUS").alias("issue"),
    )
    # What a stage decides is written down, as all later ones ask for it.
    first = cut_lineage(first)
    rest = rows.join(first, "record_number", "left_anti")

    # Stage 2: a number's candidates are counted once; who is close, and who of them is named alike, is found through cells.
    numbered = cand.where(F.coalesce("c_nr", F.lit("")) != "")
    of_number = numbered.groupBy("c_nr").agg(F.count("*").alias("n"), F.min(F.struct("candidate_id", "cx", "cy")).alias("o"))
    asked = rest.where(~blank("nr"))
    stage = cut_lineage(asked.join(of_number, F.col("nr") == F.col("c_nr")).join(counted, "nr"))
    # A source's only row with a number that one candidate has matches it at any distance; names and distances decide for the others.
    open_ = stage.where("source_nr > 1 or n > 1")
    both = numbered.withColumnRenamed("c_nr", "nr").withColumnRenamed("c_name", "name_norm")
    close = near(open_.where("source_nr = 1"), numbered.withColumnRenamed("c_nr", "nr"), ["nr"], radius).select("record_number", F.col("n").alias("n_close"), F.col("one").alias("one_close"))
    named = near(open_.where(~blank("name_norm")), both, ["nr", "name_norm"], radius).select("record_number", F.col("n").alias("n_named"), F.col("one").alias("one_named"))
    stage = stage.join(close, "record_number", "left").join(named, "record_number", "left")
    stage = stage.withColumn("one", F.struct(F.col("o.candidate_id").alias("candidate_id"), distance(F.col("x"), F.col("y"), F.col("o.cx"), F.col("o.cy")).alias("d")))
    often = F.col("source_nr") > 1
    strategy = (
        F.when(often & (F.col("n_named") == 1), "nr_inwent_name_distance")
        .when(often, None)
        .when(F.col("n") == 1, "nr_inwent")
        .when(F.col("n_named") == 1, "nr_inwent_name_distance")
        .when(F.col("n_close") == 1, "nr_inwent_distance")
    )
    stage = stage.withColumn("strategy", strategy)
    chosen = F.when(F.col("strategy") == "nr_inwent", F.col("one")).when(F.col("strategy") == "nr_inwent_name_distance", F.col("one_named")).when(F.col("strategy") == "nr_inwent_distance", F.col("one_close"))
    second = stage.withColumn("c", chosen).select(
        "record_number",
        F.when(F.col("strategy").isNotNull(), "matched").otherwise("unresolved").alias("status"),
        "strategy",
        F.col("c.candidate_id").alias("candidate_id"),
        F.col("c.d").alias("distance_m"),
        F.when(F.col("strategy").isNull(), "NR_INWENT_AMBIGUOUS").alias("issue"),
    )
    second = cut_lineage(second)
    rest = rest.join(second, "record_number", "left_anti")

    # Stage 3: the same by name alone.
    found = near(rest.where(~blank("name_norm")), cand.where(F.coalesce("c_name", F.lit("")) != "").withColumnRenamed("c_name", "name_norm"), ["name_norm"], radius)
    third = found.withColumnRenamed("one", "c").select(
        "record_number",
        F.when(F.col("n") == 1, "matched").otherwise("unresolved").alias("status"),
        F.when(F.col("n") == 1, "name_distance").alias("strategy"),
        F.when(F.col("n") == 1, F.col("c.candidate_id")).alias("candidate_id"),
        F.when(F.col("n") == 1, F.col("c.d")).alias("distance_m"),
        F.when(F.col("n") > 1, "NAME_DISTANCE_AMBIGUOUS").alias("issue"),
    )
    decided = first.unionByName(second).unionByName(third)
    return rows.select("record_number").join(decided, "record_number", "left").withColumn("status", F.coalesce("status", F.lit("new")))
