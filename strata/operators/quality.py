"""Expectations, metrics and quarantine.

* ``expect_or_drop``: keep rows whose drop-rules are TRUE (NULL fails, G7).
* ``expect_flags``: warn-only rules become boolean columns; rows are kept.
* ``dq_metrics``: pass/fail counts per rule in one aggregation pass.
* ``quarantine``: rows failing any quarantine rule, taken from the *staged*
  rows, so it holds every failing version (G5) and rules may apply to the
  quarantine only (G6).
* ``silver``: dedupe and checks in the feed's order - ``dedup_then_check``
  reproduces the reference (G3), ``check_then_dedup`` keeps the newest *good*
  version.
* ``partition_split``: labels every staged row silver / quarantine /
  superseded, a true partition of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from strata.operators.dedupe import latest, ordering_columns
from strata.session import scratch_path
from strata.sources.tables import write_table
from strata.spec import QUARANTINE, SILVER, FeedSpec, Rule


def _silver_drop_rules(rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.action == "drop" and SILVER in r.applies_to and r.sql]


def all_pass(rules: Sequence[Rule]):
    conds = [F.expr(r.passes()) for r in rules]
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def any_fail(rules: Sequence[Rule]):
    out = F.lit(False)
    for r in rules:
        out = out | F.expr(r.fails())
    return out


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    drop = _silver_drop_rules(rules)
    return df.filter(all_pass(drop)) if drop else df


def expect_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one boolean column per warn rule (named after the rule)."""
    warn = [r for r in rules if r.action == "warn"]
    return df.select("*", *[F.expr(r.passes()).alias(r.name) for r in warn])


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str = "dq") -> tuple[DataFrame, Observation]:
    """Attach in-flight pass counts; read ``obs.get`` after an action."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.expr(r.passes())).alias(f"{r.name}_pass") for r in rules if r.sql]
    return df.observe(obs, *metrics), obs


COUNTS = "feed string, rule string, action string, n_pass bigint, n_fail bigint"


def counts_table(spark: SparkSession, feed: str, observed: dict, rules: Sequence[Rule]) -> DataFrame:
    """An observation's counts as rows (``COUNTS``), one a rule."""
    rows = [(feed, r.name, r.action, observed[f"{r.name}_pass"], observed["rows"] - observed[f"{r.name}_pass"])
            for r in rules if r.sql]
    return spark.createDataFrame(rows, COUNTS).coalesce(1)


def dq_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, action, n_pass, n_fail): a pass is TRUE, a fail FALSE or NULL.
    Quarantine-only rules are counted by their quarantine predicate."""
    aggs = []
    for i, r in enumerate(rules):
        if r.sql is not None:
            aggs.append(F.count_if(F.expr(r.passes())).alias(f"p{i}"))
            aggs.append(F.count_if(~F.expr(r.passes())).alias(f"f{i}"))
        else:
            aggs.append(F.count_if(~F.coalesce(F.expr(r.fails()), F.lit(False))).alias(f"p{i}"))
            aggs.append(F.count_if(F.coalesce(F.expr(r.fails()), F.lit(False))).alias(f"f{i}"))
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{r.name}', '{r.action if SILVER in r.applies_to else QUARANTINE}', p{i}, f{i}"
        for i, r in enumerate(rules))
    return wide.selectExpr(
        f"stack({len(rules)}, {stack_args}) AS (rule, action, n_pass, n_fail)")


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    q = [r for r in rules if QUARANTINE in r.applies_to]
    return df.filter(any_fail(q))


def silver_by(staged: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Sequence[Rule],
              tie_break: Sequence[str] | None = None, mode: str = "dedup_then_check",
              method: str = "window", null_key_prefilter: bool = False,
              on_checked: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``on_checked`` is applied to the rows the rules are about to check: the
    newest versions, or all staged rows in ``check_then_dedup`` (rows that the
    NULL-key prefilter removes are in neither)."""
    df = staged
    if null_key_prefilter:
        # All NULL keys form one group whose survivor a drop rule removes
        # anyway; filtering first removes that (skewed) group from the shuffle.
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    if mode == "dedup_then_check":
        return expect_or_drop(on_checked(latest(df, keys, order, tie_break, method)), rules)
    if mode == "check_then_dedup":
        return latest(expect_or_drop(on_checked(df), rules), keys, order, tie_break, method)
    raise ValueError(f"unknown mode {mode!r}")


def silver(staged: DataFrame, spec: FeedSpec, mode: str = "dedup_then_check",
           method: str = "window", on_checked: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    return silver_by(staged, spec.key, spec.order, spec.rules, spec.tie_break, mode, method,
                     spec.null_key_prefilter, on_checked)


def failed_rules(rules: Sequence[Rule]):
    """array<string> of the names of the rules a row fails, in rule order.
    NULLs (passed rules) are removed by ``array_except`` against ``[NULL]``,
    which runs in generated code, unlike a per-element lambda; rule names are
    distinct, so its de-duplication changes nothing."""
    return F.array_except(
        F.array(*[F.when(F.expr(r.fails()), F.lit(r.name)) for r in rules]),
        F.array(F.lit(None).cast("string")),
    )


def partition_split(staged: DataFrame, keys: Sequence[str], order: Sequence[str],
                    rules: Sequence[Rule], tie_break: Sequence[str] | None = None,
                    label_col: str = "label", rules_col: str = "failed_rules") -> DataFrame:
    """Label each staged row: ``quarantine`` if it fails a silver drop rule,
    else ``silver`` if it is the newest version of its key, else
    ``superseded``.  Silver rows equal ``dedup_then_check``'s output; the three
    labels partition the input.

    Ranking every version with a window would send all versions of a hot key
    to one task.  Instead each key's newest version is picked by a partial and
    final ``max_by`` and joined back on a row id, which is unique and so
    spreads evenly.  The numbered rows are stored once in the shared scratch
    folder, so both uses, and any retry, read the same ids whatever the input.
    """
    drop = _silver_drop_rules(rules)
    cols = ordering_columns(staged, keys, order, tie_break)
    path = scratch_path(staged.sparkSession, "split")
    write_table(staged.withColumn("_rid", F.monotonically_increasing_id()), path)
    with_id = staged.sparkSession.read.parquet(path)
    winners = with_id.groupBy(*keys).agg(
        F.max_by("_rid", F.struct(*cols, "_rid")).alias("_rid")).select("_rid", F.lit(True).alias("_newest"))
    ranked = with_id.join(winners, "_rid", "left")
    label = (F.when(any_fail(drop), F.lit("quarantine"))
             .when(F.col("_newest"), F.lit("silver"))
             .otherwise(F.lit("superseded")))
    return ranked.select(*staged.columns, label.alias(label_col),
                         failed_rules(drop).alias(rules_col))
