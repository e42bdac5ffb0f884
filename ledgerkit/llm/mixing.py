"""Operator 1, mixing sources to target weights: budgets down a domain-language-source tree.

Every node passes its token budget to its children in proportion to their target weights.  A
child whose subtree cannot use its part (supply times the most epochs allowed) is filled, and
what it leaves goes to its siblings in proportion to their weights; only what a whole subtree
cannot use was never handed to it, so a shortage moves to siblings before it moves to
ancestors' siblings.  In closed form over the children sorted by capacity per weight: the first
k are filled, the others share the rest.

A leaf's budget is spent in epochs.  Whole epochs take each document of the leaf once; the last
takes the prefix of the documents in that epoch's seeded order whose tokens fit.  The prefix is
found without sorting a leaf: the order's hash range is cut in about sqrt(rows) parts, the parts'
token sums give the one part in which the budget ends, and only its rows are ranked.

Only DataFrame operations.  Defined results: nulls in a tree column are one node named
``(none)``; a null or empty text has no tokens, and a document without tokens is never taken;
rows that repeat an id are taken one by one; an empty table gives no rows; other columns are
kept as they are, the operator's own (domain, n_tokens, epoch, mix_order) win over equal names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, read, set_aside, text_of, written

LEVELS = ("domain", "lang", "source")
#: Target weights of the registered query; a node without an entry has DEFAULT_WEIGHT.
WEIGHTS = {"domain": {"web": 40, "books": 30, "reference": 20, "forum": 10},
           "lang": {"en": 50, "de": 20, "fr": 15, "es": 15}, "source": {}}
DEFAULT_WEIGHT = 10
#: Tokens asked for in hundredths of all tokens, and how often a document may be taken at most.
BUDGET_PERCENT = 90
MAX_EPOCHS = 2
SEED = 20240


def domain_of(source: str = "source") -> Column:
    """The domain of a numbered source: five sources in a row belong together."""
    n = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), r"(\d+)$", 1).try_cast("long")
    return (F.when(n.isNull(), "(none)").when(n % 20 < 5, "web").when(n % 20 < 10, "books")
            .when(n % 20 < 15, "reference").otherwise("forum"))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = [F.when(F.col(level) == k, F.lit(w)) for k, w in sorted(weights.get(level, {}).items())]
    return F.coalesce(*known, F.lit(DEFAULT_WEIGHT)).cast("long")


def shared_out(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """Adds ``budget`` to sibling rows (weight, capacity): each gets its share of the parent's
    budget, at most its capacity, and what the filled ones leave goes to the others."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = [(F.col("capacity") / F.col("weight")).asc(), F.col("_name").asc()]
    upto = by.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = (nodes.withColumn("_given", budget)
         .withColumn("_filled", F.sum("capacity").over(upto) - F.col("capacity"))
         .withColumn("_open", F.sum("weight").over(by) - F.sum("weight").over(upto) + F.col("weight"))
         .withColumn("_level", F.greatest(F.lit(0.0), (F.col("_given") - F.col("_filled")).cast("double") / F.col("_open")))
         .withColumn("_full", F.col("capacity") <= F.col("_level") * F.col("weight"))
         .withColumn("_rest", F.min(F.when(~F.col("_full"), F.struct(F.col("_filled"), F.col("_open")))).over(by)))
    rest = (F.col("_given") - F.col("_rest._filled")).cast("double") * F.col("weight") / F.col("_rest._open")
    out = F.when(F.col("_full"), F.col("capacity")).otherwise(F.greatest(F.lit(0), F.floor(rest)))
    return n.withColumn("budget", out.cast("long")).drop("_given", "_filled", "_open", "_level", "_full", "_rest", "_name")


def leaf_budgets(leaves: DataFrame, levels: tuple[str, ...], weights: dict[str, dict[str, int]],
                 budget_percent: int, max_epochs: int) -> DataFrame:
    """(levels, n_rows, supply) with the leaf's budget.  The rows are tree nodes, not documents."""
    known = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    nodes, parent = None, []
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        here = known.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("supply").alias("supply"),
                                        F.sum("n_rows").alias("n_rows"))
        here = here.withColumns({"weight": weight_of(level, weights), "_name": F.col(level)})
        if nodes is None:
            total = F.sum("supply").over(Window.partitionBy(F.lit(0)))
            given = F.floor(total * budget_percent / 100).cast("long")
        else:
            here = here.join(nodes.select(*parent, F.col("budget").alias("_parent")), parent)
            given = F.col("_parent")
        nodes = shared_out(here, parent, given).drop("_parent")
        parent = path
    return nodes


def seeded(seed: int, epoch: Column, key: Column) -> Column:
    """The order of one epoch: 32 hexadecimal digits, the same for the same seed, epoch and key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def mix(docs: DataFrame, levels: tuple[str, ...] = LEVELS, weights: dict[str, dict[str, int]] | None = None,
        budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The taken documents, one row per document and epoch, with n_tokens, epoch and mix_order."""
    weights = WEIGHTS if weights is None else weights
    levels = tuple(levels)
    node = [f"_n_{x}" for x in levels]  # tree columns with no nulls, beside the input's own
    rows = docs.drop("n_tokens", "epoch", "mix_order").withColumns(
        {a: F.coalesce(F.col(x).cast("string"), F.lit("(none)")) for a, x in zip(node, levels)})
    rows = rows.withColumn("n_tokens", F.regexp_count(text_of(), F.lit(WORD)).cast("long"))
    counted = written(rows.select(*node, "doc_id", "n_tokens").where("n_tokens > 0"), "tokens")
    leaves = counted.groupBy(*node).agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("supply"))
    leaves = leaves.withColumnsRenamed(dict(zip(node, levels)))
    budgets = leaf_budgets(leaves, levels, weights, budget_percent, max_epochs)
    budgets = budgets.withColumnsRenamed(dict(zip(levels, node))).select(
        *node, "supply", "budget",
        F.floor(F.col("budget") / F.col("supply")).cast("int").alias("_whole"),
        (F.col("budget") % F.col("supply")).alias("_last"),
        F.ceil(F.sqrt("n_rows")).cast("long").alias("_parts"))
    budgets = written(budgets, "budgets")  # its size is known from the files: Spark broadcasts it only if small
    part = F.floor(F.conv(F.substring("mix_order", 1, 8), 16, 10).cast("long") * F.col("_parts") / F.lit(2 ** 32)).cast("long")

    def ordered(df: DataFrame) -> DataFrame:
        return (df.join(budgets, node).withColumn("mix_order", seeded(seed, F.col("_whole"), F.col("doc_id")))
                .withColumn("_part", part))

    sums = ordered(counted).groupBy(*node, "_part", "_last").agg(F.sum("n_tokens").alias("_in"))
    upto = Window.partitionBy(*node).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("_upto", F.sum("_in").over(upto))
    ends = (sums.where(F.col("_upto") > F.col("_last")).groupBy(*node)
            .agg(F.min("_part").alias("_end"), F.min(F.col("_upto") - F.col("_in")).alias("_before")))
    ends = written(ends, "ends")
    base = ordered(rows.where("n_tokens > 0")).join(ends, node)
    inner = [c for c in rows.columns if c not in node]
    whole = (base.withColumn("_copies", F.col("_whole") + F.when(F.col("_part") < F.col("_end"), 1).otherwise(0))
             .where("_copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))))
    whole = whole.withColumn("mix_order", seeded(seed, F.col("epoch"), F.col("doc_id")))
    last = base.where(F.col("_part") == F.col("_end"))
    tokens = F.sum("n_tokens").over(Window.partitionBy(*node).orderBy("mix_order", "doc_id", F.xxhash64(text_of()))
                                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = (last.withColumn("_sum", tokens + F.col("_before")).where(F.col("_sum") <= F.col("_last"))
            .withColumn("epoch", F.col("_whole")))
    keep = [*inner, "epoch", "mix_order"]
    return whole.select(*keep).unionByName(last.select(*keep))


def mixed(docs: DataFrame) -> DataFrame:
    """The taken documents with the columns of ``docs``; a document taken in two epochs is there twice."""
    inner, back = set_aside(docs, ("doc_id", "text", "lang", "source"))
    return mix(inner.withColumn("domain", domain_of())).select(*back)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("domain", domain_of())
    return mix(docs).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch", "mix_order")


def _tree_sql() -> str:
    """Water filling level by level, as in :func:`leaf_budgets`."""
    case = lambda level: "CASE " + level + "".join(f" WHEN '{k}' THEN {w}" for k, w in sorted(WEIGHTS[level].items())) + f" ELSE {DEFAULT_WEIGHT} END" if WEIGHTS[level] else str(DEFAULT_WEIGHT)
    out = []
    for d, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[:d + 1]), ", ".join(LEVELS[:d])
        by = f"PARTITION BY {parent}" if parent else ""
        source = (f"SELECT {path}, sum(supply) * {MAX_EPOCHS} AS cap, sum(supply) AS supply, {case(level)} AS w FROM leaves GROUP BY {path}")
        given = (f"floor((SELECT sum(supply) FROM leaves) * {BUDGET_PERCENT} / 100)" if not d else f"p{d - 1}.budget")
        join = f" JOIN p{d - 1} USING ({parent})" if d else ""
        out.append(f"""a{d} AS (SELECT n.*, CAST({given} AS BIGINT) AS given FROM ({source}) n{join}),
b{d} AS (SELECT *, sum(cap) OVER ({by} ORDER BY cap::DOUBLE / w, {level} ROWS UNBOUNDED PRECEDING) - cap AS filled,
  sum(w) OVER ({by}) - sum(w) OVER ({by} ORDER BY cap::DOUBLE / w, {level} ROWS UNBOUNDED PRECEDING) + w AS open FROM a{d}),
c{d} AS (SELECT *, cap <= greatest(0.0, (given - filled)::DOUBLE / open) * w AS full_ FROM b{d}),
d{d} AS (SELECT *, min(CASE WHEN NOT full_ THEN filled END) OVER ({by}) AS rf,
  max(CASE WHEN NOT full_ THEN open END) OVER ({by}) AS ro FROM c{d}),
p{d} AS (SELECT {path}, supply, CAST(CASE WHEN full_ THEN cap ELSE greatest(0, floor((given - rf)::DOUBLE * w / ro)) END AS BIGINT) AS budget FROM d{d})""")
    return ",\n".join(out)


ORACLE = rf"""WITH docs AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, lang AS l0, source AS s0,
    CASE WHEN regexp_extract(coalesce(source, ''), '(\d+)$', 1) = '' THEN '(none)'
      ELSE CASE WHEN k % 20 < 5 THEN 'web' WHEN k % 20 < 10 THEN 'books' WHEN k % 20 < 15 THEN 'reference' ELSE 'forum' END END AS domain,
    n_tokens, text
  FROM (SELECT *, try_cast(regexp_extract(coalesce(source, ''), '(\d+)$', 1) AS BIGINT) AS k,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents)
  WHERE n_tokens > 0),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply FROM docs GROUP BY ALL),
{_tree_sql()},
taken AS (SELECT d.*, p.budget // p.supply AS whole, p.budget % p.supply AS last_ FROM docs d JOIN p2 p USING (domain, lang, source)),
sums AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
  ORDER BY md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM taken),
copies AS (SELECT *, unnest(range(0, CAST(whole + CASE WHEN upto <= last_ THEN 1 ELSE 0 END AS BIGINT))) AS e FROM sums)
SELECT doc_id, domain, l0 AS lang, s0 AS source, n_tokens, CAST(e AS INT) AS epoch,
  md5('{SEED}:' || e || ':' || coalesce(doc_id::VARCHAR, '')) AS mix_order FROM copies"""
