"""Mixing sources to target weights through a domain-language-source tree, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.llm.shared import settled, stored

LEVELS = ("domain", "language", "source")
#: Leaf plans of up to so many rows are broadcast; more are joined by a shuffle.
SMALL = 1 << 14
#: Times that a leaf's last bucket is parted by two more digits.
STEPS = 3


def _fill(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Share each parent's ``budget`` among its children by ``weight``, none beyond its ``room``.

    Children are taken by rising room per weight: those whose room is below their share are filled,
    and what they lack goes to their siblings in proportion. Whole tokens: shares are rounded
    down, and the tokens left over go one each to the first of the other children by name.
    """
    by = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), name)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    big = lambda c: F.col(c).cast("decimal(38,0)")
    steps = nodes.withColumn("above", big("budget") - F.coalesce(F.sum(big("room")).over(before), F.lit(0)))
    steps = steps.withColumn("heavy", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    steps = steps.withColumn("full", big("room") * big("heavy") <= F.col("above") * big("weight"))
    first = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), F.col(name), "above", "heavy"))).over(whole)
    steps = steps.withColumn("cut", first)
    share = F.when(F.col("full"), big("room")).otherwise(F.expr("cast(cast(weight as decimal(38,0)) * cut.above div cut.heavy as decimal(38,0))"))
    steps = steps.withColumn("share", share)
    left = F.col("cut.above") - F.sum(F.when(~F.col("full"), F.col("share"))).over(whole)
    turn = F.row_number().over(Window.partitionBy(*parent, "full").orderBy(name))
    steps = steps.withColumn("share", (F.col("share") + F.when(~F.col("full") & (turn <= left), 1).otherwise(0)).cast("long"))
    return steps.drop("above", "heavy", "full", "cut", "budget")


def budgets(leaves: DataFrame, budget: int, weights: dict[str, Column], epochs: int) -> DataFrame:
    """``(domain, language, source, tokens, share)``: the tokens each leaf of the tree is to give.

    ``leaves`` has the tokens of each leaf; its room is ``epochs`` times these. A node's room is that of its
    leaves. The budget goes down the tree: domains by their weights, languages of a domain, sources of a
    language; a node never gets more than its room, and what it can't take goes to its siblings. So a
    shortage of a leaf stays with its siblings as long as they have room, and passes to the ancestor's
    siblings only then. A budget over all room fills everything. Weights are whole numbers given by columns
    over the node's names; nodes without a positive weight get nothing, nor does anything below them.
    """
    leaves = leaves.withColumn("room", F.col("tokens") * epochs)
    for level in LEVELS:
        leaves = leaves.withColumn(f"{level}_weight", weights[level].cast("long"))
    live = leaves.where(" and ".join(f"{level}_weight > 0" for level in LEVELS) + " and room > 0")
    above = None
    for depth, level in enumerate(LEVELS):
        names = list(LEVELS[: depth + 1])
        nodes = live.groupBy(*names).agg(F.sum("room").alias("room"), F.max(f"{level}_weight").alias("weight"))
        if above is None:
            total = F.sum("room").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("root", F.lit(0)).withColumn("budget", F.least(F.lit(budget).cast("long"), total.cast("long")))
            above = _fill(nodes, ["root"], level)
        else:
            above = _fill(nodes.join(above.select(*names[:-1], F.col("share").alias("budget")), names[:-1]), names[:-1], level)
    return above.select(*LEVELS, F.expr(f"room div {epochs}").alias("tokens"), "share")


def mix_to_weights(docs: DataFrame, budget_share: float, weights: dict[str, Column], domain: Column, epochs: int = 4, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", language_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents' rows, and ``mix_domain``, ``mix_epoch``, ``mix_tokens`` and ``mix_taken``: a row for each time one is taken.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+``. The budget is ``budget_share`` of all tokens; ``budgets`` shares it among the
    leaves. A leaf gives a prefix of an endless row of its documents: whole epochs, each in a seeded order of
    its own (by md5 of seed, epoch and id, then id and text), then as much of the next epoch as its
    share still takes. A document is taken if the prefix reaches it; ``mix_taken`` is how many of its tokens lie
    in the prefix, all but for the last one.

    The prefix is found without a running sum over a leaf: sums of buckets by the first two digits of a document's md5, 256 for each leaf, tell
    which bucket the prefix ends in, and the same is done ``STEPS`` times within that bucket. Buckets before it are taken whole; only the last one, one in
    16.7 million of a leaf's documents, is summed document by document. Leaf plans, a row for each leaf, are joined back.

    Null domains, languages and sources are leaves named ``?``. Null and empty texts have no tokens and no share:
    they are never taken. Texts of any length count whole. A null id is taken like any other, in the order of its text; repeated rows are taken each. Given columns
    named ``mix_domain``, ``mix_epoch``, ``mix_tokens`` and ``mix_taken`` are replaced. An empty table, or no weight, gives an empty result.
    """
    docs = docs.drop("mix_domain", "mix_epoch", "mix_tokens", "mix_taken")
    words = F.expr(f"coalesce(regexp_count(doc.`{text_col}`, '[^\\\\x20\\\\x09-\\\\x0D]+'), 0)").cast("long")
    named = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    order = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col).cast("binary")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), named(domain).alias("domain"), named(F.col(language_col)).alias("language"), named(F.col(source_col)).alias("source"), order.alias("order"))
    # Words are counted once for the plan, and once more for the documents that it takes.
    sizes = stored(rows.select(*LEVELS, "order", words.alias("n")).where("n > 0"), "sizes")
    leaves = settled(sizes.groupBy(*LEVELS).agg(F.sum("n").alias("tokens")))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = budgets(leaves, int(total * budget_share), weights, epochs).where("share > 0")
    plan = settled(plan.select(*LEVELS, F.expr("share div tokens").alias("whole"), (F.col("share") % F.col("tokens")).alias("rest")))

    def planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
        """Each row with its leaf's plan, which goes to every task if it has few rows."""
        own = rows.join(F.broadcast(plan) if plan.count() <= SMALL else plan, list(LEVELS))
        return own.withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.col("whole"), F.lit(":"), F.col("order")).cast("binary")))

    # The bucket that the prefix ends in, two digits longer each time, and the tokens before it.
    plan = plan.withColumns({"last": F.lit(""), "start": F.lit(0).cast("long")})
    for step in range(STEPS):
        within = planned(sizes, plan.where("rest > 0")).where("startswith(key, last)").withColumn("bucket", F.substring("key", 1, 2 * step + 2))
        sums = within.groupBy(*LEVELS, "rest", "start", "bucket").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy(*LEVELS).orderBy("bucket")
        ends = sums.withColumn("upto", F.col("start") + F.sum("n").over(upto)).where("upto - n < rest and upto >= rest")
        plan = settled(plan.drop("last", "start").join(ends.select(*LEVELS, F.col("bucket").alias("last"), (F.col("upto") - F.col("n")).alias("start")), list(LEVELS), "left"))
    every = planned(rows, plan).withColumn("bucket", F.substring("key", 1, 2 * STEPS))
    upto = Window.partitionBy(*LEVELS).orderBy("key", "order", f"doc.{text_col}").rowsBetween(Window.unboundedPreceding, 0)
    ending = every.where("bucket = last").withColumn("n", words).where("n > 0").withColumn("start", F.col("start") + F.sum("n").over(upto) - F.col("n")).where("start < rest")
    cols = [F.col("doc.*"), F.col("domain").alias("mix_domain"), F.col("epoch").alias("mix_epoch"), F.col("n").alias("mix_tokens"), F.col("taken").alias("mix_taken")]
    sure = every.where("whole > 0 or bucket < last").withColumn("n", words).where("n > 0").select("*", F.expr("explode(sequence(0L, whole)) as epoch"), F.col("n").alias("taken")).where("epoch < whole or bucket < last")
    return sure.select(*cols).union(ending.select("*", F.col("whole").alias("epoch"), F.least("n", F.col("rest") - F.col("start")).alias("taken")).select(*cols))


#: What the registered query and the pipeline ask for: a domain is a fifth of the numbered sources.
WEIGHTS = {
    "domain": "case domain when 'd0' then 6 when 'd1' then 5 when 'd2' then 4 when 'd3' then 3 else 2 end",
    "language": "case language when 'en' then 6 when 'de' then 3 when 'fr' then 3 else 1 end",
    "source": "case source when 'src0' then 2 else 1 end",
}


def standard_mix(docs: DataFrame, budget_share: float, epochs: int) -> DataFrame:
    """``mix_to_weights`` with the weights above; the source's number tells the domain."""
    domain = F.concat(F.lit("d"), (F.expr("try_cast(substring(source, 4) as bigint)") % 5).cast("string"))
    return mix_to_weights(docs, budget_share, {k: F.expr(v) for k, v in WEIGHTS.items()}, domain, epochs)


def _fill_sql(name: str, nodes: str, parent: str) -> str:
    """DuckDB: ``_fill`` over the rows of ``nodes``."""
    by = f"PARTITION BY {parent} ORDER BY room::DOUBLE / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""{name}_a AS (SELECT *, budget - coalesce(sum(room::HUGEINT) OVER ({by}), 0) AS above,
    sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER ({by}), 0) AS heavy FROM {nodes}),
{name}_b AS (SELECT *, room::HUGEINT * heavy <= above * weight AS full_ FROM {name}_a),
{name}_c AS (SELECT *, first_value(above) OVER u AS cut_above, first_value(heavy) OVER u AS cut_heavy FROM {name}_b
    WINDOW u AS (PARTITION BY {parent}, full_ ORDER BY room::DOUBLE / weight, {name})),
{name}_d AS (SELECT *, CASE WHEN full_ THEN room ELSE (weight * cut_above) // cut_heavy END AS part,
    row_number() OVER (PARTITION BY {parent}, full_ ORDER BY {name}) AS turn FROM {name}_c),
{name}_e AS (SELECT * EXCLUDE (budget, above, heavy, cut_above, cut_heavy, part, turn, full_), CAST(part + CASE WHEN NOT full_
    AND turn <= cut_above - sum(part) OVER (PARTITION BY {parent}, full_) THEN 1 ELSE 0 END AS BIGINT) AS share FROM {name}_d)"""


def standard_mix_sql(budget_share: float, epochs: int, seed: int = 7) -> str:
    """DuckDB: the rows of the registered query, with plain running sums."""
    return f"""WITH docs AS (SELECT *, coalesce('d' || (TRY_CAST(substring(source, 4) AS BIGINT) % 5), '?') AS domain,
    coalesce(lang, '?') AS language, coalesce(source, '?') AS leaf,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
leaves AS (SELECT domain, language, leaf AS source, sum(n) AS tokens FROM docs WHERE n > 0 GROUP BY ALL),
live AS (SELECT *, tokens * {epochs} AS room, {WEIGHTS["domain"]} AS dw, {WEIGHTS["language"]} AS lw, {WEIGHTS["source"]} AS sw FROM leaves),
domain_n AS (SELECT domain, sum(room) AS room, max(dw) AS weight, least((SELECT CAST(floor(sum(tokens) * {budget_share}::DOUBLE) AS BIGINT) FROM leaves),
    sum(sum(room)) OVER ()) AS budget FROM live GROUP BY domain),
{_fill_sql("domain", "domain_n", "1")},
language_n AS (SELECT l.*, share AS budget FROM (SELECT domain, language, sum(room) AS room, max(lw) AS weight FROM live GROUP BY ALL) l JOIN domain_e USING (domain)),
{_fill_sql("language", "language_n", "domain")},
source_n AS (SELECT l.*, share AS budget FROM (SELECT domain, language, source, room, sw AS weight FROM live) l JOIN language_e USING (domain, language)),
{_fill_sql("source", "source_n", "domain, language")},
plan AS (SELECT domain, language, source AS leaf, share // tokens AS whole, share % tokens AS rest
    FROM (SELECT *, room // {epochs} AS tokens FROM source_e) WHERE share > 0),
own AS (SELECT docs.*, whole, rest, md5(concat('{seed}:', CAST(whole AS BIGINT), ':', coalesce(CAST(doc_id AS VARCHAR), md5(text)))) AS key FROM docs JOIN plan USING (domain, language, leaf) WHERE n > 0),
summed AS (SELECT *, sum(n) OVER (PARTITION BY domain, language, leaf ORDER BY key, CAST(doc_id AS VARCHAR), text ROWS UNBOUNDED PRECEDING) - n AS start FROM own)
SELECT doc_id, domain AS mix_domain, lang, source, CAST(unnest(generate_series(0, CAST(whole AS BIGINT) - 1)) AS BIGINT) AS mix_epoch, n AS mix_tokens, n AS mix_taken FROM own WHERE whole > 0
UNION ALL SELECT doc_id, domain, lang, source, CAST(whole AS BIGINT), n, CAST(least(n, rest - start) AS BIGINT) FROM summed WHERE start < rest"""
