"""Composite dataset jobs (D1-D4): filings -> records -> published version."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import extract as X
from ..operators.metadata import assert_unique_keys, join_metadata
from ..operators.normalise import flatten_record, normalise
from ..session import folders, materialise, path_exists
from ..sinks import writers as K
from ..sources.archives import archive_months, read_archives
from ..vocab import PRODUCT_COVERAGE_FIELDS


def parse_month(filings: DataFrame) -> DataFrame:
    """Filings of one month -> flat financial records (no metadata), with month."""
    recs = flatten_record(normalise(X.parse_filings(filings)))
    return recs.withColumn("month", F.date_format("published", "yyyy-MM"))


STEPS = ("read the filings of the trailing months out of their archives, inner ones included",
         "extract the tagged facts and normalise both reporting standards to one record with provenance",
         "join the company register without personal data, where one is given",
         "write the records as a versioned Parquet table with preview, coverage and this manifest")
PERSONAL_DATA = "left out by design: no names of persons, dates of birth or address lines; town and outward postcode only"


def described(manifest: DataFrame, version: str, sources=(), licence: str | None = None) -> DataFrame:
    """K7: the manifest's counts with where the data come from and how they were made."""
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    return manifest.withColumns({
        "version": F.lit(version), "generated": F.current_date().cast("string"), "sources": texts(sources),
        "licence": F.lit(licence).cast("string"), "processing_steps": texts(STEPS), "personal_data": F.lit(PERSONAL_DATA)})


def _written(records: DataFrame, base: str, version: str, sources, licence) -> str:
    """The version with its reports.  Coverage and match rate (V3) are observed in the tasks that write
    the version, so they need no scan of it; preview and manifest read a few columns of it."""
    seen, spark = Observation(f"version-{uuid.uuid4().hex}"), records.sparkSession
    fields = [c for c in PRODUCT_COVERAGE_FIELDS if c in records.columns]
    matched = [F.count("company_name").alias("matched")] if "company_name" in records.columns else []
    out = K.write_version(records.observe(seen, F.count(F.lit(1)).alias("rows"), *matched, *[F.count(c).alias(f"n_{c}") for c in fields]), base, version)
    n = seen.get
    share = lambda k: F.round(F.lit(n[k]) / F.lit(max(n["rows"], 1)), 4)
    K.write_manifest(spark.range(1).select(F.lit(n["rows"]).alias("record_count"), *[share(f"n_{c}").alias(f"cov_{c}") for c in fields],
                                           *([F.lit(n["matched"]).alias("matched"), share("matched").alias("match_rate")] if matched else [])), f"{out}/_coverage")
    written = spark.read.parquet(out)
    K.write_preview(written, f"{out}/_preview")
    K.write_manifest(described(A.manifest(written), version, sources, licence), f"{out}/_manifest")
    return out


def publish(records: DataFrame, meta: DataFrame, base: str, version: str, sources=(), licence: str | None = None) -> dict:
    """Normalise numbers, join metadata, write the version, preview, manifest and coverage.
    A register that names a company twice stops the job before anything is written."""
    assert_unique_keys(meta.where("company_number is not null"), "company_number")
    return {"version": _written(flatten_record(join_metadata(records, meta)), base, version, sources, licence)}


def build_sample(filings: DataFrame, meta: DataFrame | None, out: str) -> dict:
    """One archive end to end: records, concept counts, CSV + Parquet + manifest."""
    parsed = materialise(X.parse_filings(filings))  # read as records and as facts, parsed once
    recs = flatten_record(normalise(parsed))
    if meta is not None:
        recs = join_metadata(recs, meta)
    K.write_parquet(recs, f"{out}/records")
    written = recs.sparkSession.read.parquet(f"{out}/records")
    K.write_csv(written, f"{out}/csv")
    K.write_manifest(A.manifest(written, X.facts(parsed)), f"{out}/manifest")
    return {"records": f"{out}/records"}


#: A trial build takes so many months and filings per archive.
TRIAL_MONTHS, TRIAL_FILINGS = 1, 3000


def _archive_of() -> Column:
    """The archive that a filing came from, by its full path; loose filings are one group a month."""
    return F.when(F.col("filing_id").contains("!"), F.substring_index("filing_id", "!", 1)).otherwise(F.lit(""))


def _part_of(archive: Column, build: str) -> Column:
    return F.md5(F.concat(archive, F.lit(f"\0{build}")))


def _newest_months(keys: DataFrame, months: int) -> DataFrame:
    return keys.select("month").where("month is not null").distinct().orderBy(F.desc("month")).limit(months)


def _build(keys: DataFrame, filings_of, meta: DataFrame | None, base: str, version: str, months: int,
           rebuild: bool, sources, licence) -> dict:
    """``keys``: (month, archive, length) of what there is; ``filings_of(pending)``: the filings of some of them.

    A ledger beside the parts says which archives they hold.  It is written after the parts, and a
    build's parts have names of its own, so one that died leaves its archives pending and all earlier
    parts whole.  Parts that the ledger does not name (or no longer) are removed at the end."""
    spark, build = keys.sparkSession, uuid.uuid4().hex
    parts, ledger = f"{base.rstrip('/')}/_parts", f"{base.rstrip('/')}/_ledger"
    keys = materialise(keys.withColumn("archive_part", _part_of(F.col("archive"), build)))
    keep = _newest_months(keys, months)
    wanted = keys.join(keep, "month", "left_semi")
    if not rebuild and path_exists(spark, ledger):
        wanted = K.pending_archives(wanted, K.read_ledger(spark, ledger))
    wanted = materialise(wanted)
    if not wanted.isEmpty():
        built = parse_month(filings_of(wanted)).withColumn("archive_part", _part_of(_archive_of(), build))
        K.write_month_parts(built, parts, extra=("archive_part",))
        K.append_ledger(wanted, spark.read.schema(built.schema).parquet(parts), ledger)
    if not path_exists(spark, ledger):
        raise FileNotFoundError(f"no dated archive to build {base} from")
    K.drop_parts_but(K.read_ledger(spark, ledger), parts)
    held = K.read_ledger(spark, ledger).where("records > 0").join(keep, "month", "left_semi")
    recs = (spark.read.parquet(parts).withColumn("month", F.col("month").cast("string"))
            .join(held, ["month", "archive_part"], "left_semi").drop("archive_part"))
    if meta is None:
        out = _written(recs, base, version, sources, licence)
    else:
        out = publish(recs, meta, base, version, sources, licence)["version"]
    K.write_manifest(keys.where("month is null").select("archive"), f"{out}/_undated")
    return {"version": out}


def build_product(filings: DataFrame, meta: DataFrame | None, base: str, version: str,
                  months: int = 12, trial: bool = False, rebuild: bool = False, sources=(), licence: str | None = None) -> dict:
    """D3: trailing months (W3) -> per-month records (D1, K3) -> publish.

    Archives that the ledger names are not parsed again (J14) unless ``rebuild``; an archive that
    comes after its month's first build, or holds another number of filings, is in the next version.  Archives of filings without a
    publication date belong to no month; they are listed in ``_undated``.  A trial takes one month
    and caps filings per archive (W5); it writes to folders of its own."""
    from ..operators.sampling import cap_per_group
    month = F.date_format("published", "yyyy-MM")
    if trial:
        months, base = TRIAL_MONTHS, f"{base.rstrip('/')}_trial"
    keys = filings.groupBy(month.alias("month"), _archive_of().alias("archive")).agg(F.count(F.lit(1)).alias("length"))

    def chosen(pending: DataFrame) -> DataFrame:
        rows = filings.withColumns({"month": month, "_archive": _archive_of()})
        some = pending.select("month", F.col("archive").alias("_archive"))
        rows = rows.join(some, ["month", "_archive"], "left_semi").drop("month", "_archive")
        return cap_per_group(rows, "archive", TRIAL_FILINGS, "filing_id") if trial else rows

    return _build(keys, chosen, meta, base, version, months, rebuild, sources, licence)


def build_from_archives(archives: DataFrame, meta: DataFrame | None, base: str, version: str,
                        months: int = 12, rebuild: bool = False, sources=(), licence: str | None = None) -> dict:
    """D3 over a listing (path, length): months come from the archives' names, so only pending
    archives are opened.  An archive whose length has changed is pending again."""
    dated = archives.select("path", "length").distinct().mapInArrow(archive_months, "month string, archive string, length long")
    return _build(dated, lambda pending: read_archives(pending.select(F.col("archive").alias("path"))),
                  meta, base, version, months, rebuild, sources, licence)


def read_dataset(spark, base: str, columns=None) -> DataFrame:
    """The newest ``version=`` folder under ``base`` (by name), reading only the
    wanted columns that exist in it.  The folder listing is metadata on the driver."""
    versions = [n for n in folders(spark, base) if n.startswith("version=")]
    if not versions:
        raise FileNotFoundError(f"no version folder under {base}")
    df = spark.read.parquet(f"{base.rstrip('/')}/{versions[-1]}")
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return df
