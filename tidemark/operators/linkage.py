"""Genome assemblies and sequencing runs: normalised assembly table, linkage by prioritised keys, enriched runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import non_missing, null_normalised, strain_or_isolate


def assembly_core(assemblies: DataFrame) -> DataFrame:
    """One row an assembly; placeholders become null, strain or isolate one column."""
    keep = [c for c in assemblies.columns if c not in ("infraspecific_name", "isolate")]
    clean = {c: null_normalised(c).alias(c) for c in ("biosample", "bioproject", "taxid", "species_taxid")}
    return assemblies.select(*[clean.get(c, F.col(c)) for c in keep], strain_or_isolate("infraspecific_name", "isolate").alias("strain_or_isolate")).dropDuplicates(["assembly_accession"])


TIERS = (("biosample", 1), ("bioproject", 2), ("taxid", 3))


def tier_members(assemblies: DataFrame) -> DataFrame:
    """tier, value, assembly_accession: the assemblies behind each key of each tier, to join with linked runs where all are wanted."""
    out = None
    for c, tier in TIERS:
        d = assemblies.where(F.col(c).isNotNull()).select(F.lit(tier).alias("tier"), F.col(c).alias("value"), "assembly_accession")
        out = d if out is None else out.union(d)
    return out


def link_runs(runs: DataFrame, assemblies: DataFrame) -> DataFrame:
    """Runs (run, biosample, bioproject, taxid) with their best tier: BioSample, then BioProject, then taxon.

    Only tier 1 shows the same sample. A run that links is one row: run, tier, the key's ``value``, how many assemblies
    share it (``n``) and the ``least`` of them; ``tier_members`` has the others, so no run meets all assemblies of a wide
    key. Runs are reduced to their distinct keys first, which keeps a popular key from repeating joins.
    """
    found = runs.select("biosample", "bioproject", "taxid").distinct()
    for c, tier in TIERS:
        side = assemblies.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("assembly_accession").alias("least"))
        hit = side.select("value", F.struct(F.lit(tier).alias("tier"), "value", "n", "least").alias(f"t{tier}"))
        found = found.join(hit, F.when(non_missing(c), F.col(c)) == F.col("value"), "left").drop("value")
    found = found.select("biosample", "bioproject", "taxid", F.coalesce("t1", "t2", "t3").alias("t")).where("t is not null")
    same = [runs[c].eqNullSafe(found[c]) for c in ("biosample", "bioproject", "taxid")]
    return runs.join(found, same[0] & same[1] & same[2]).select(runs["run"], "t.*")


def enriched_runs(downloadable: DataFrame, experiments: DataFrame, samples: DataFrame, attributes: DataFrame, tags: list[str]) -> DataFrame:
    """Downloadable runs with strategy, platform, sample ids and the listed attribute tags as columns; the runs are joined once, last."""
    wide = attributes.where(F.col("tag").isin(*tags)).groupBy("sample_accession").pivot("tag", tags).agg(F.min("value"))
    e = experiments.select(F.col("experiment_accession").alias("Experiment"), "library_strategy", "platform", "sample_accession")
    s = samples.select("sample_accession", "bio_sample_id", "taxon_id")
    whole = e.join(s.join(wide, "sample_accession", "left"), "sample_accession", "left")
    return downloadable.select("Accession", "Experiment", "Spots_i64", "Bases_i64", "BioProject").join(whole, "Experiment", "left")


def selected_runs(linked: DataFrame, best: int = 1) -> DataFrame:
    """Runs of a tier up to ``best`` with their first assembly, for a download list; a run that is there twice is listed once."""
    return linked.where(F.col("tier") <= best).groupBy("run").agg(F.min("tier").alias("tier"), F.min("least").alias("assembly_accession"))
