"""Mixing sources to target weights: hierarchical budgeting over a tree of domain, language and source.

1. Every leaf (domain, language, source) offers its tokens up to `max_epochs` times.
2. The budget runs down the tree.  At each node it is shared among the children by weight; a child gets no more than its subtree
   can offer, and what it cannot take goes to its siblings, by weight again, before anything reaches the siblings of its parent
   (`shared`: water filling in closed form, by one window per parent over sums in order of offer / weight; whole numbers
   throughout, so up to one token per child is lost to rounding).
3. A leaf's share is some full epochs and a rest.  An epoch's order is the MD5 of seed, epoch and doc_id; the rest is the longest
   prefix of its epoch's order whose tokens fit.  Prefixes are found without sorting a leaf: sums per leaf and leading hex digits
   locate the digits where the rest ends, and only rows with those digits are ordered.
4. Leaf plans (full epochs and the last key of the rest) decide each row by itself: texts are never shuffled.

All DataFrame functions; tokens are words unless a column says otherwise.

Defined cases: null texts have 0 tokens; null languages or sources are leaves of their own, and so is the null domain; rows with
equal doc_id share their place in the order and are taken or left together; an empty table gives an empty mix; other columns are
neither read nor touched.  Weights not listed are 1; a weight of 0 takes a subtree out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table, unused

LEVELS = ("domain", "lang", "source")
DIGITS = 3
#: Plans of more leaves are joined by a shuffle, not broadcast.
MOST_LEAVES = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights by level and name (0 or more, whole), the budget as a share (in percent) of all tokens, epochs and seed."""

    weights: dict = field(default_factory=dict)
    percent: int = 100
    max_epochs: int = 4
    seed: int = 17
    domains: dict = field(default_factory=dict)


#: The production mix.  Domains are groups of sources; those not listed are 'other'.
PRODUCTION = Mix(
    weights={"domain": {"web": 4, "forum": 2, "books": 2}, "lang": {"en": 6, "de": 2, "fr": 2}, "source": {"src0": 3}},
    percent=100,
    max_epochs=2,
    seed=17,
    domains={"web": ["src0", "src1", "src2", "src3", "src4"], "forum": ["src5", "src6", "src7", "src8", "src9"], "books": ["src10", "src11", "src12", "src13", "src14"]},
)


def token_count(text: Column) -> Column:
    """Maximal runs without ASCII white space; 0 for null."""
    parts = F.size(F.split(text, r"[\x09-\x0D\x20]+"))
    space = [" ", "\t", "\n", "\v", "\f", "\r"]
    ends = F.substring(text, 1, 1).isin(space).cast("int") + F.right(text, F.lit(1)).isin(space).cast("int")
    return F.coalesce(F.when(F.length(text) == 0, 0).otherwise(parts - ends), F.lit(0)).cast("long")


def domain_of(source: Column, domains: dict) -> Column:
    found = F.when(source.isNull(), F.lit(None).cast("string"))
    for name, members in sorted(domains.items()):
        found = found.when(source.isin(members), F.lit(name))
    return found.otherwise(F.lit("other"))


def weight_of(level: str, weights: dict) -> Column:
    found = F.when(F.lit(False), F.lit(1))
    for name, weight in sorted(weights.get(level, {}).items()):
        found = found.when(F.col(level) == name, F.lit(int(weight)))
    return found.otherwise(F.lit(1)).cast("decimal(10,0)")


def shared(children: DataFrame, parent: list[str], name: str, weights: dict) -> DataFrame:
    """Adds `share` to children (parent columns, name, offer, budget of the parent), by water filling among siblings."""
    rows = children.withColumn("w", weight_of(name, weights)).withColumn("ratio", F.when(F.col("w") > 0, F.col("offer").cast("double") / F.col("w").cast("double")))
    siblings = Window.partitionBy(*parent)
    rising = siblings.orderBy(F.col("ratio").asc_nulls_last(), F.col(name).asc_nulls_first())
    before = F.coalesce(F.sum("offer").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    sated = rows.withColumn("sated", F.coalesce(F.col("offer") * onward <= F.col("w") * (F.col("budget") - before), F.lit(False)))
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("sated"), F.col("offer"))).over(siblings), F.lit(0))
    hungry = F.sum(F.when(~F.col("sated"), F.col("w"))).over(siblings)
    open_ = sated.withColumns({"rest": rest.cast("decimal(27,0)"), "hungry": hungry.cast("decimal(20,0)")})
    part = F.expr("CASE WHEN hungry > 0 THEN (w * rest) DIV hungry ELSE 0 END")
    share = F.when(F.col("sated"), F.col("offer")).otherwise(F.least(F.col("offer"), part.cast("decimal(18,0)")))
    return open_.withColumn("share", share.cast("decimal(18,0)")).drop("w", "ratio", "sated", "rest", "hungry", "budget")


def leaf_shares(stats: DataFrame, mix: Mix) -> DataFrame:
    """Tokens of each leaf's share.  stats: domain, lang, source, tokens."""
    leaves = stats.withColumn("offer", (F.col("tokens") * mix.max_epochs).cast("decimal(18,0)"))
    total = stats.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * mix.percent).alias("t")).select(F.expr("t DIV 100").cast("decimal(18,0)").alias("budget"))
    above, keys = total.withColumn("__root", F.lit(0)), ["__root"]
    rows = leaves.withColumn("__root", F.lit(0))
    for level in LEVELS:
        grouped = rows.groupBy(*keys, level).agg(F.sum("offer").cast("decimal(18,0)").alias("offer"), F.sum("tokens").alias("tokens"))
        same = [grouped[k].eqNullSafe(above[k]) for k in keys]
        children = grouped.join(above, same).select(*[grouped[k] for k in keys], grouped[level], grouped["offer"], grouped["tokens"], above["budget"])
        above = shared(children, keys, level, mix.weights)
        keys = [*keys, level]
        if level != LEVELS[-1]:
            above = above.select(*keys, F.col("share").alias("budget"))
    return above.select(*LEVELS, "tokens", "share")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch, F.coalesce(doc_id.cast("string"), F.lit("-"))))


def leaf_plans(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: full epochs, and the last key taken of the epoch after them.  rows: LEVELS, doc_id, tokens."""
    shares = leaf_shares(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), mix)
    full = F.expr("CAST(CASE WHEN tokens > 0 THEN share DIV tokens ELSE 0 END AS INT)")
    plans = cut(shares.withColumn("full", full).withColumn("rest", (F.col("share") - F.col("full") * F.col("tokens")).cast("long")).select(*LEVELS, "full", "rest"))
    placed = with_plan(rows, plans).withColumn("key", order_key(mix.seed, F.col("full"), F.col("doc_id"))).withColumn("digits", F.substring("key", 1, DIGITS))
    sums = placed.groupBy(*LEVELS, "digits", "rest").agg(F.sum("tokens").alias("tokens"))
    running = Window.partitionBy(*LEVELS).orderBy("digits")
    ends = sums.withColumn("upto", F.sum("tokens").over(running)).where("upto > rest")
    ends = ends.groupBy(*LEVELS).agg(F.min(F.struct("digits", (F.col("upto") - F.col("tokens")).alias("before"))).alias("e")).select(*LEVELS, "e.digits", "e.before")
    inside = Window.partitionBy(*LEVELS).orderBy("key")  # rows of one leaf that share their leading digits
    last = with_plan(placed, ends, ["digits"]).withColumn("upto", F.col("before") + F.sum("tokens").over(inside))
    last = last.where("upto <= rest").groupBy(*LEVELS).agg(F.max("key").alias("key"))
    cuts = with_plan(ends.select(*LEVELS, "digits"), last, how="left").select(*LEVELS, F.coalesce("key", "digits").alias("last"))
    return cut(with_plan(plans, cuts, how="left").select(*LEVELS, "full", F.coalesce("last", F.lit("g")).alias("last")))


def with_plan(rows: DataFrame, plan: DataFrame, more: list[str] | None = None, how: str = "inner") -> DataFrame:
    """rows with the columns of a table that has one row per leaf; null names match null names."""
    names = {c: f"__p_{c}" for c in plan.columns}
    keys = [*LEVELS, *(more or [])]
    side = plan.select([F.col(c).alias(n) for c, n in names.items()])
    joined = rows.join(side, [F.col(k).eqNullSafe(F.col(names[k])) for k in keys], how)
    return joined.select("*", *[F.col(n).alias(c) for c, n in names.items() if c not in keys]).drop(*names.values())


def taken(rows: DataFrame, plans: DataFrame, mix: Mix, leaf: dict[str, Column], doc_id: Column, epoch: str = "__epoch") -> DataFrame:
    """rows once per epoch that takes them, with the epoch in a new column of that name.  Columns of rows stay as they are."""
    mark = "__p"
    while any(c.lower().startswith(mark) for c in rows.columns):
        mark += "_"
    side = plans.select([F.col(c).alias(f"{mark}_{c}") for c in plans.columns])
    side = F.broadcast(side) if side.count() <= MOST_LEAVES else side
    joined = rows.join(side, [leaf[k].eqNullSafe(F.col(f"{mark}_{k}")) for k in LEVELS])
    rest = order_key(mix.seed, F.col(f"{mark}_full"), doc_id) <= F.col(f"{mark}_last")
    epochs = F.concat(
        F.when(F.col(f"{mark}_full") > 0, F.sequence(F.lit(0), F.col(f"{mark}_full") - 1)).otherwise(F.array().cast("array<int>")),
        F.when(rest, F.array(f"{mark}_full")).otherwise(F.array().cast("array<int>")),
    )
    return joined.withColumn(epoch, F.explode(epochs)).drop(*side.columns)


def leaves_of(docs: DataFrame, mix: Mix) -> DataFrame:
    return docs.select("doc_id", domain_of(F.col("source"), mix.domains).alias("domain"), "lang", "source", token_count(F.col("text")).alias("tokens"))


def mixed_ids(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """doc_id, leaf, tokens, epoch and order_key of every taken row; an epoch's rows come in order of order_key."""
    rows = cut(leaves_of(docs, mix))
    found = taken(rows, leaf_plans(rows, mix), mix, {k: F.col(k) for k in LEVELS}, F.col("doc_id"))
    return found.select("doc_id", *LEVELS, "tokens", F.col("__epoch").alias("epoch"), order_key(mix.seed, F.col("__epoch"), F.col("doc_id")).alias("order_key"))


def mixed_docs(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """The taken rows of docs with their columns as they were, once per epoch that takes them."""
    plans = leaf_plans(cut(leaves_of(docs, mix)), mix)
    leaf = {"domain": domain_of(docs["source"], mix.domains), "lang": docs["lang"], "source": docs["source"]}
    epoch = unused(docs, "__epoch")
    return taken(docs, plans, mix, leaf, docs["doc_id"], epoch).drop(epoch)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_ids(table(spark, sf_dir, "documents"))


def _cases(level: str, mix: Mix) -> str:
    return "CASE " + "".join(f"WHEN {level} = '{n}' THEN {w} " for n, w in sorted(mix.weights.get(level, {}).items())) + "WHEN FALSE THEN 1 ELSE 1 END"


def _level(name: str, rows: str, parent: list[str], level: str, mix: Mix) -> str:
    by = ", ".join(parent) or "1"
    return f"""
{name}_c AS (
  SELECT c.*, ({_cases(level, mix)})::HUGEINT AS w FROM {rows} c
), {name}_r AS (
  SELECT *, CASE WHEN w > 0 THEN offer::DOUBLE / w::DOUBLE END AS ratio FROM {name}_c
), {name}_s AS (
  SELECT *, coalesce(offer * (sum(w) OVER (PARTITION BY {by} ORDER BY ratio ASC NULLS LAST, {level} ASC NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    <= w * (budget - coalesce(sum(offer) OVER (PARTITION BY {by} ORDER BY ratio ASC NULLS LAST, {level} ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), false) AS sated
  FROM {name}_r
), {name} AS (
  SELECT *, CASE WHEN sated THEN offer ELSE least(offer, coalesce(
      (w * (budget - coalesce(sum(CASE WHEN sated THEN offer END) OVER (PARTITION BY {by}), 0))) // nullif(sum(CASE WHEN NOT sated THEN w END) OVER (PARTITION BY {by}), 0), 0)) END AS share
  FROM {name}_s
)"""


def mixing_sql(mix: Mix = PRODUCTION, docs: str = "documents") -> str:
    """The same mix in DuckDB's SQL, with one sorted window per leaf in place of the located prefix."""
    domain = "CASE WHEN source IS NULL THEN NULL " + "".join(f"WHEN source IN ({', '.join(repr(x) for x in m)}) THEN '{n}' " for n, m in sorted(mix.domains.items())) + "ELSE 'other' END"
    on = lambda a, b, keys: " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)
    key = lambda epoch: f"md5({mix.seed} || '|' || {epoch} || '|' || coalesce(doc_id::VARCHAR, '-'))"
    return f"""
WITH r AS (
  SELECT doc_id, {domain} AS domain, lang, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens FROM {docs}
), leaf AS (
  SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {mix.max_epochs} AS offer FROM r GROUP BY ALL
), d AS (
  SELECT domain, sum(offer)::HUGEINT AS offer, (SELECT (coalesce(sum(tokens), 0) * {mix.percent}) // 100 FROM r) AS budget FROM leaf GROUP BY domain
), {_level("domains", "d", [], "domain", mix)}, l AS (
  SELECT leaf.domain, leaf.lang, sum(leaf.offer)::HUGEINT AS offer, any_value(domains.share) AS budget
  FROM leaf JOIN domains ON {on("leaf", "domains", ["domain"])} GROUP BY leaf.domain, leaf.lang
), {_level("langs", "l", ["domain"], "lang", mix)}, s AS (
  SELECT leaf.domain, leaf.lang, leaf.source, leaf.tokens, leaf.offer, langs.share AS budget
  FROM leaf JOIN langs ON {on("leaf", "langs", ["domain", "lang"])}
), {_level("sources", "s", ["domain", "lang"], "source", mix)}, plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS full_epochs,
    share - CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END * tokens AS rest FROM sources
), placed AS (
  SELECT r.*, full_epochs, rest, {key("full_epochs")} AS k FROM r JOIN plan ON {on("r", "plan", LEVELS)}
), run AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto FROM placed
), epochs AS (
  SELECT doc_id, domain, lang, source, tokens, unnest(range(full_epochs::BIGINT))::INTEGER AS epoch FROM placed
  UNION ALL SELECT doc_id, domain, lang, source, tokens, full_epochs::INTEGER FROM run WHERE upto <= rest
)
SELECT doc_id, domain, lang, source, tokens, epoch, {key("epoch")} AS order_key FROM epochs
"""
