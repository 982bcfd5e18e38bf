"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain - language - source; leaves are sources within a language within a
domain. A token budget flows down from the root: at each node it is divided among the
children by their weights, but no child gets more than its capacity (its tokens times
``max_epochs``); what a child cannot take goes to its siblings, and since a node never gets
more than its children can take together, a shortage reaches the siblings of an ancestor only
when all siblings below are full. Each leaf then takes whole documents in a seeded order,
epoch after epoch: all documents once for each full epoch, and of the last epoch the prefix
whose tokens fit the rest of the budget.

Weights: ``weights`` maps "domain", "lang" and "source" to {name: weight}; names without a
weight weigh as much as the tokens they hold (natural proportion) where a level has no
weights at all, and 1 where it has some.

Scale: texts are never shuffled. One pass counts tokens (staged, a few numbers a document);
budgets are windows over the tree's nodes, one row per leaf; the cut in a leaf is found from
sums per 1/4096 of its order key, then inside one such part only, so a leaf that holds a
third of all rows is never sorted in one task. A document's number of copies follows from
its own key and its leaf's cut.

Defined results: null text holds no tokens; such documents cost nothing and stay as often as
their leaf's full epochs say, and in the prefix by their key; null lang, source or domain
count as the empty name; repeated rows (same doc_id) share a key and stay or go together; an
empty table gives an empty result; extra columns pass through, an existing ``epoch`` column
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import free_name, stage

SEED = 17
MAX_EPOCHS = 2
PART_DIGITS = 3  # leading hex digits of the order key that make 4096 parts of a leaf
DOMAINS = ["web", "books", "code", "reference"]
WEIGHTS = {"domain": {"web": 4, "books": 2, "code": 2, "reference": 2},
           "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}
LEVELS = ["domain", "lang", "source"]


def domain_of(source: Column) -> Column:
    """Domain of a source: by its number, in turn."""
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(source, "([0-9]{1,9})$", 1), F.lit("")),
                                        F.lit("999999999")), F.lit(0))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS)).cast("int") + 1)


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\r]+")).cast("bigint")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def level_weight(level: str, weights: dict, tokens: str) -> Column:
    given = weights.get(level)
    if not given:
        return F.greatest(F.col(tokens), F.lit(1)).cast("decimal(19,0)")
    out = F.lit(None)
    for name, w in given.items():
        out = F.when(F.col(level) == name, F.lit(int(w))).otherwise(out)
    return F.coalesce(out, F.lit(1)).cast("decimal(19,0)")


def divide(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``nodes`` (parent columns, child, capacity, weight, budget of the parent) with the
    child's own ``share``.

    Children in order of capacity per weight: a child is full while its capacity is at most
    its part of what is left; the others share the rest by weight.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity").cast("double") / F.col("weight").cast("double")).asc(),
                                                F.col(child))
    whole = Window.partitionBy(*parent)
    d = "decimal(19,0)"
    nodes = (nodes.where("weight > 0")
             .withColumn("before", F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("left", (F.col("budget") - F.coalesce("before", F.lit(0))).cast(d))
             .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(d)))
    nodes = nodes.withColumn("full", F.col("capacity").cast(d) * F.col("weights") <= F.col("left") * F.col("weight"))
    rest = F.max(F.when(~F.col("full"), F.col("left"))).over(whole)
    over = F.max(F.when(~F.col("full"), F.col("weights"))).over(whole)
    nodes = nodes.withColumn("rest", rest).withColumn("over", over)
    return nodes.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(
        F.expr("rest * weight div over"))).drop("before", "left", "weights", "full", "rest", "over", "budget")


def leaf_budgets(leaves: DataFrame, weights: dict, max_epochs: int, target_tokens: int | None) -> DataFrame:
    """(domain, lang, source, tokens, budget) from (domain, lang, source, tokens)."""
    tree = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    langs = tree.groupBy("domain", "lang").agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("domain").agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity"))
    root = domains.agg(F.least(F.sum("capacity"), F.lit(target_tokens).cast("bigint") if target_tokens is not None
                               else F.sum("tokens")).alias("budget")).withColumn("root", F.lit(1))

    def weighted(nodes: DataFrame, level: str) -> DataFrame:
        return nodes.withColumn("weight", level_weight(level, weights, "tokens"))

    top = weighted(domains, "domain").withColumn("root", F.lit(1)).join(root, "root")
    of_domain = divide(top, ["root"], "domain").select("domain", F.col("share").alias("budget"))
    of_lang = divide(weighted(langs, "lang").join(of_domain, "domain"), ["domain"], "lang").select(
        "domain", "lang", F.col("share").alias("budget"))
    of_source = divide(weighted(tree, "source").join(of_lang, ["domain", "lang"]), ["domain", "lang"], "source")
    return of_source.select(*LEVELS, "tokens", F.col("share").cast("bigint").alias("budget"))


def mix(docs: DataFrame, weights: dict = WEIGHTS, max_epochs: int = MAX_EPOCHS, target_tokens: int | None = None,
        seed: int = SEED, domain: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, each with its ``epoch`` (from
    0). ``target_tokens`` defaults to the tokens there are: the same size in new proportions."""
    name = {"domain": domain if domain is not None else domain_of(F.col("source")),
            "lang": F.col("lang"), "source": F.col("source")}
    tree_columns = [F.coalesce(name[c].cast("string"), F.lit("")).alias(c) for c in LEVELS]
    counted = stage(docs.select(F.col("doc_id"), *tree_columns,
                                (tokens if tokens is not None else token_count(F.col("text"))).alias("n")), "mix-tokens")
    leaves = counted.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    budgets = leaf_budgets(leaves, weights, max_epochs, target_tokens)
    # a leaf without tokens has nothing to divide: one epoch, no prefix
    plan = stage(budgets.withColumn("epochs", F.expr("if(tokens > 0, budget div tokens, 1)"))
                 .withColumn("room", F.expr("if(tokens > 0, budget % tokens, 0)")), "mix-plan")

    # last key of each leaf's prefix: by parts of the key first, then within the part of the cut
    keyed = counted.join(plan.drop("tokens", "budget"), LEVELS).withColumn(
        "key", order_key(seed, F.col("epochs"), F.col("doc_id")))
    keyed = keyed.withColumn("part", F.substring("key", 1, PART_DIGITS))
    parts = keyed.groupBy(*LEVELS, "part", "room").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("upto", F.sum("n").over(running))
    cut = parts.where("upto > room").groupBy(*LEVELS).agg(
        F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("before"))).alias("cut"))
    inside = keyed.join(cut, LEVELS).where("part = cut.part").groupBy(*LEVELS, "room", "cut", "key").agg(
        F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("upto", F.col("cut.before") + upto).where("upto > room").groupBy(*LEVELS).agg(
        F.min("key").alias("first_out"))
    # every key below the first one left out is in; a leaf that is never cut keeps them all
    decided = stage(plan.select(*LEVELS, "epochs").join(last, LEVELS, "left"), "mix-cuts")

    # names that no column of docs has
    own = {c: free_name(f"mix_{c}", docs.columns) for c in (*LEVELS, "epochs", "first_out", "copies")}
    d = decided.select(*[F.col(c).alias(own[c]) for c in (*LEVELS, "epochs", "first_out")])
    on = [F.coalesce(name[c].cast("string"), F.lit("")) == F.col(own[c]) for c in LEVELS]
    epochs, first_out, copies = (F.col(own[c]) for c in ("epochs", "first_out", "copies"))
    extra = F.when(first_out.isNull() | (order_key(seed, epochs, F.col("doc_id")) < first_out), 1).otherwise(0)
    joined = docs.drop("epoch").join(d, on).withColumn(own["copies"], (epochs + extra).cast("int"))
    return (joined.where(copies > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
            .drop(*own.values()))


def oracle(weights: dict = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL for doc_id, epoch, domain, lang, source, n_tokens of ``mix`` over documents."""
    def weight(level: str) -> str:
        given = weights.get(level)
        if not given:
            return "greatest(tokens, 1)::HUGEINT"
        return "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {int(w)}" for n, w in given.items()) + " ELSE 1 END::HUGEINT"

    def divided(out: str, rel: str, parent: str, child: str) -> str:
        order = f"PARTITION BY {parent} ORDER BY capacity::DOUBLE / weight::DOUBLE, {child}"
        return f"""{out}_a AS (SELECT *, budget - COALESCE(SUM(capacity) OVER ({order}
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS lft,
            SUM(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS ws
            FROM ({rel}) WHERE weight > 0),
        {out}_b AS (SELECT *, capacity::HUGEINT * ws <= lft * weight AS is_full FROM {out}_a),
        {out} AS (SELECT * EXCLUDE (budget), CASE WHEN is_full THEN capacity ELSE
            (MAX(CASE WHEN NOT is_full THEN lft END) OVER (PARTITION BY {parent}) * weight)
            // MAX(CASE WHEN NOT is_full THEN ws END) OVER (PARTITION BY {parent}) END AS share FROM {out}_b)"""

    def key(epoch: str) -> str:
        return f"md5('{seed}:' || {epoch}::VARCHAR || ':' || COALESCE(doc_id::VARCHAR, ''))"

    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    return f"""
    WITH counted AS (
      SELECT doc_id, [{domains}][COALESCE(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT), 0)
               % {len(DOMAINS)} + 1] AS domain,
             COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
             len(regexp_extract_all(COALESCE(text, ''), '[^ \\t\\n\\r]+'))::BIGINT AS n FROM documents),
    leaves AS (SELECT domain, lang, source, SUM(n)::BIGINT AS tokens, SUM(n)::BIGINT * {max_epochs} AS capacity
               FROM counted GROUP BY ALL),
    langs AS (SELECT domain, lang, SUM(tokens)::BIGINT AS tokens, SUM(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL),
    domains AS (SELECT domain, SUM(tokens)::BIGINT AS tokens, SUM(capacity)::BIGINT AS capacity FROM langs GROUP BY ALL),
    {divided("of_domain", f"SELECT *, {weight('domain')} AS weight, SUM(tokens) OVER ()::HUGEINT AS budget FROM domains",
             "1", "domain")},
    {divided("of_lang", f"SELECT l.*, {weight('lang')} AS weight, d.share AS budget FROM langs l JOIN "
             "(SELECT domain, share FROM of_domain) d USING (domain)", "domain", "lang")},
    {divided("of_source", f"SELECT s.*, {weight('source')} AS weight, l.share AS budget FROM leaves s JOIN "
             "(SELECT domain, lang, share FROM of_lang) l USING (domain, lang)", "domain, lang", "source")},
    plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 1 END AS epochs,
                    CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS room FROM of_source),
    keyed AS (SELECT c.*, epochs, room, {key('epochs')} AS k FROM counted c JOIN plan USING (domain, lang, source)),
    ranked AS (SELECT *, SUM(n) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto FROM keyed),
    outs AS (SELECT domain, lang, source, MIN(k) AS first_out FROM ranked WHERE upto > room GROUP BY ALL),
    copies AS (SELECT r.*, epochs + CASE WHEN first_out IS NULL OR k < first_out THEN 1 ELSE 0 END AS n_copies
               FROM ranked r LEFT JOIN outs USING (domain, lang, source))
    SELECT doc_id, unnest(range(0, n_copies::BIGINT))::INTEGER AS epoch, domain, lang, source, n AS n_tokens
    FROM copies WHERE n_copies > 0"""
