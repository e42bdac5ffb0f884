"""Entity and charge dataset (P2-P4, K10): targets and a charges register -> two CSV files and a manifest."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import entities as E
from ..operators.metadata import assert_unique_keys
from ..session import materialise
from ..sinks import writers as K

PERSONAL_DATA = "names of individuals entitled to a charge are redacted; only corporate names are kept"


def build_entity_dataset(targets: DataFrame, charges: DataFrame, out: str, version: str, sources=(), licence: str | None = None) -> dict:
    """Write ``entities`` and ``charges`` (CSV with a header) and ``manifest`` (JSON) under ``out``.

    A company that is a target twice stops the job, as it would double its charges.  The register is
    read once; the manifest's counts are observed while the files are written, so nothing is scanned
    again.  Targets without charges count zero; charges of other companies are left out."""
    assert_unique_keys(targets, "company_number")
    spark = targets.sparkSession
    own = materialise(charges.join(targets.select("company_number"), "company_number", "left_semi"))
    count = F.count(F.lit(1))
    seen = {name: Observation(f"{name}-{version}") for name in ("entities", "charges")}
    K.write_csv(E.entity_rows(targets, own).observe(
        seen["entities"], count.alias("entities"), F.count_if(F.col("charges_total") > 0).alias("with_charges"),
        F.count_if(F.col("category") == "spv").alias("spvs"), F.count_if(F.col("category") == "lender").alias("lenders")), f"{out}/entities")
    K.write_csv(E.charge_rows(own, targets).observe(
        seen["charges"], count.alias("charges"), F.count_if(F.col("status") == "outstanding").alias("outstanding"),
        F.count_if("persons_entitled_has_individual").alias("with_individuals")), f"{out}/charges")
    counts = seen["entities"].get | seen["charges"].get
    told = spark.range(1).select(
        F.lit(version).alias("version"), F.current_date().cast("string").alias("generated"),
        *[F.lit(n).cast("long").alias(c) for c, n in counts.items()],
        F.array(*[F.lit(x) for x in sources]).cast("array<string>").alias("sources"),
        F.lit(licence).cast("string").alias("licence"), F.lit(PERSONAL_DATA).alias("personal_data"))
    K.write_manifest(told, f"{out}/manifest")
    return {"entities": f"{out}/entities", "charges": f"{out}/charges", "manifest": f"{out}/manifest"}
