"""Fuzzy header resolver: maps each dataset's drifting headers to the fixed targets.

Semantics per (dataset, target), aliases tried in list order:
  1. for alias k: ``col_k`` = header with the highest ratio(alias, header), first header on
     ties; ``s_k`` its score; ``n_k`` = non-blank row count of ``col_k``;
  2. ``iF`` = first alias with the highest score, ``iC`` = first alias with the highest count;
  3. resolved  <=>  s[iF] > 80  and  (iF != iC  or  n[iF] > 0); the source is ``col[iF]``.

Plan shape (no Python, no per-file loop, no join of data against data):
  * scores are computed once per *distinct* header string; the 92 aliases are a literal
    array exploded next to each header (a Generate, not a join);
  * the only data-sized step is the non-blank count, produced by the source in the same
    pass that profiles it: posexplode(cells) then a partial (map-side) aggregate per
    (dataset, column position), so each map task ships one row per column;
  * the best header per alias is found once per distinct header list (files from one
    template share it), then the decisions work on (#datasets x #aliases) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftsweep.functions.similarity import char_masks, indel_ratio, lcs_fast, passes_threshold
from driftsweep.operators.joins import join_checked
from driftsweep.schema import alias_rows

KEY = ["file_name", "source"]


def alias_array(rows: list[tuple[int, str, int, str]] | None = None) -> Column:
    """The alias catalogue as one literal array<struct> (92 entries by default)."""
    rows = alias_rows() if rows is None else rows
    return F.array(*[
        F.struct(F.lit(t_no).alias("target_no"), F.lit(t).alias("target"),
                 F.lit(a_no).alias("alias_no"), F.lit(a).alias("alias"))
        for t_no, t, a_no, a in rows])


def header_rows(datasets: DataFrame) -> DataFrame:
    """(file_name, source, pos, header) for every column of every dataset."""
    return datasets.select(*KEY, F.posexplode("headers").alias("pos", "header"))


def header_scores(headers: DataFrame, aliases: Column | None = None) -> DataFrame:
    """Score every distinct header string against every alias.

    Output: header, target_no, target, alias_no, alias, lcs, score, passes.
    """
    aliases = alias_array() if aliases is None else aliases
    distinct = headers.select("header").distinct()
    # match masks once per distinct header, shared by all 92 aliases
    pairs = distinct.select("header", char_masks(F.col("header")).alias("masks"), F.inline(aliases))
    lcs = lcs_fast(F.col("alias"), F.col("header"), F.col("masks"))
    return (pairs.withColumn("lcs", lcs).drop("masks")
            .withColumn("score", indel_ratio(F.col("alias"), F.col("header"), F.col("lcs")))
            .withColumn("passes", passes_threshold(F.col("alias"), F.col("header"), F.col("lcs"))))


def named_counts(headers: DataFrame, counts: DataFrame) -> DataFrame:
    """(file_name, source, header, n_non_blank): the position counts with header names."""
    return (headers.join(counts, [*KEY, "pos"], "left")
            .select(*KEY, "header", F.coalesce("n_non_blank", F.lit(0)).cast("long").alias("n_non_blank")))


def best_headers(datasets: DataFrame, scores: DataFrame) -> DataFrame:
    """Best header per (dataset, target, alias): highest score, first column on ties.

    The answer depends only on the dataset's header list, and files exported from one
    template share it, so the arg-max runs once per distinct header list (layout) and is
    attached to the datasets by an equi-join on the layout's digest: neither the key nor
    the broadcast rows carry the list.
    """
    datasets = datasets.withColumn("layout", F.sha2(F.to_json("headers"), 256))
    layouts = datasets.select("layout", "headers").dropDuplicates(["layout"])
    cols = layouts.select("layout", F.posexplode("headers").alias("pos", "header"))
    joined = cols.join(scores, "header")
    best = F.max_by(F.struct("header", "pos", "score", "passes"),
                    F.struct(F.col("score"), -F.col("pos")))
    per_layout = (joined.groupBy("layout", "target_no", "target", "alias_no", "alias")
                  .agg(best.alias("b")))
    # one layout may be shared by a third of all datasets: broadcast the per-layout answers
    # (about 92 rows a layout) after a size check, salted shuffle join beyond it
    return (join_checked(datasets.select(*KEY, "layout"), per_layout, ["layout"], salt_from=KEY)
            .select(*KEY, "target_no", "target", "alias_no", "alias",
                    F.col("b.header").alias("found"), F.col("b.pos").alias("found_pos"),
                    F.col("b.score").alias("score"), F.col("b.passes").alias("passes")))


def match_report(best: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per alias tried: the header found, its score and its non-blank row count."""
    c = counts.select(*KEY, F.col("pos").alias("found_pos"), "n_non_blank")
    return (best.join(c, [*KEY, "found_pos"], "left")
            .withColumn("row_count", F.coalesce(F.col("n_non_blank"), F.lit(0)).cast("long"))
            .drop("n_non_blank"))


def decide(report: DataFrame) -> DataFrame:
    """Per (dataset, target): the arg-max decisions and whether the target resolves."""
    by_score = F.max_by(F.struct("alias_no", "found", "found_pos", "score", "passes", "row_count"),
                        F.struct(F.col("score"), -F.col("alias_no")))
    by_count = F.max_by(F.col("alias_no"), F.struct(F.col("row_count"), -F.col("alias_no")))
    d = (report.groupBy(*KEY, "target_no", "target")
         .agg(by_score.alias("f"), by_count.alias("i_count")))
    resolved = F.col("f.passes") & ((F.col("f.alias_no") != F.col("i_count")) | (F.col("f.row_count") > 0))
    return d.select(*KEY, "target_no", "target",
                    F.col("f.alias_no").alias("i_score"), "i_count",
                    F.col("f.found").alias("found"), F.col("f.found_pos").alias("found_pos"),
                    F.col("f.score").alias("score"),
                    F.col("f.row_count").alias("row_count"), resolved.alias("resolved"))


def source_col(target: str) -> str:
    """Mapping column holding the source column position of ``target`` (NULL: unresolved)."""
    return f"src_{target}"


def mapping_table(decisions: DataFrame) -> DataFrame:
    """One row per dataset with at least one resolved target and one int column per
    target: the position of its source column, NULL when unresolved.

    Flat columns, not a map: a map lookup scans its keys, and the projection looks up all
    33 targets for every data row. The aggregate is fixed-width (hash) and each group
    holds at most 33 rows.
    """
    from driftsweep.schema import TARGETS

    pos = [F.max(F.when(F.col("target") == t, F.col("found_pos"))).alias(source_col(t)) for t in TARGETS]
    return decisions.where("resolved").groupBy(*KEY).agg(*pos)


def day_first_col(target: str) -> str:
    """Mapping column telling that the slash dates of ``target``'s source column are day first."""
    return f"day_first_{target}"


def day_first_targets(decisions: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per dataset with a day-first date column: one boolean column per date target."""
    from driftsweep.schema import DATE_TARGETS

    voted = counts.where("day_first").select(*KEY, F.col("pos").alias("found_pos"))
    dates = decisions.where(F.col("resolved") & F.col("target").isin(DATE_TARGETS)).join(voted, [*KEY, "found_pos"], "left_semi")
    return dates.groupBy(*KEY).agg(*[F.bool_or(F.col("target") == t).alias(day_first_col(t)) for t in DATE_TARGETS])


def resolve(accepted_datasets: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
    """Full resolver plan; returns the intermediate tables for reporting and tests.

    ``mapping``: file_name, source, file_ordinal and one ``src_<target>`` column per target.

    ``counts``: (file_name, source, pos, n_non_blank) over the data rows of each dataset; with a column
    ``day_first`` the mapping also tells which date targets are to be read day first.
    """
    headers = header_rows(accepted_datasets)
    scores = header_scores(headers)
    best = best_headers(accepted_datasets, scores)
    report = match_report(best, counts)
    decisions = decide(report)
    mapping = mapping_table(decisions).join(accepted_datasets.select(*KEY, "file_ordinal"), KEY)
    if "day_first" in counts.columns:
        mapping = mapping.join(day_first_targets(decisions, counts), KEY, "left")
    return {"headers": headers, "scores": scores, "best": best, "counts": named_counts(headers, counts),
            "report": report, "decisions": decisions, "mapping": mapping}
