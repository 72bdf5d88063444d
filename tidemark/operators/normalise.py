"""The published table from current state, and the logs of what was changed and what is wrong."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, identifiers
from tidemark.operators import consensus, match
from tidemark.operators.fold import with_asof


def spelling_map(state: DataFrame, aliases: DataFrame, words: dict[str, str] | None, known: DataFrame | None = None) -> DataFrame:
    """The resolved spellings of the state, with the resolver's version; ``known`` saves those it has of the same version."""
    wanted = state.select(F.col("nz").alias("nz_raw")).distinct()
    version = F.lit(match.RESOLVER_VERSION)
    if known is None or "resolver_version" not in known.columns:
        return match.resolve(wanted, aliases, words).withColumn("resolver_version", version)
    known = known.where(F.col("resolver_version") == version)
    fresh = wanted.alias("w").join(known.alias("k"), F.col("w.nz_raw").eqNullSafe(F.col("k.nz_raw")), "left_anti")
    return known.unionByName(match.resolve(fresh, aliases, words).withColumn("resolver_version", version))


def normalised(state: DataFrame, spellings: DataFrame, units: DataFrame, calendar: DataFrame, as_of: date) -> DataFrame:
    """One wide row a record: region, plausible dates, brand and model, identifier parts, lifecycle with its uncertainty."""
    last_read = calendar.agg(F.max("snapshot_date")).first()[0]
    rows = state.join(units, "ovd", "left")
    m = spellings.select(F.col("nz_raw").alias("m_raw"), "nz_clean", "brand", "manufacturer", "model", F.col("method").alias("nz_method"), "homoglyph_fixed")
    rows = rows.join(m, F.col("nz").eqNullSafe(F.col("m_raw")), "left").drop("m_raw")
    rows = with_asof(rows, calendar, "first_seen", "first_seen_after")
    rows = identifiers.with_parts(rows, "imei")
    return rows.select(
        "record_key",
        "ovd",
        "region",
        "unit_type",
        dates.plausible(F.col("insert_date"), as_of).alias("insert_date"),
        dates.plausible(F.col("dk"), as_of).alias("dk"),
        dates.implausible(F.col("insert_date"), as_of).alias("insert_date_implausible"),
        F.col("insert_date").alias("insert_date_raw"),
        F.nullif(F.trim("nk"), F.lit("")).alias("nk"),
        F.nullif(F.trim("dtl"), F.lit("")).alias("dtl"),
        F.col("nz").alias("nz_raw"),
        "nz_clean",
        "brand",
        "manufacturer",
        "model",
        "nz_method",
        "homoglyph_fixed",
        F.col("imei").alias("imei_raw"),
        *identifiers.PARTS,
        "first_seen",
        F.when(F.col("is_present"), F.lit(last_read)).otherwise(F.col("last_seen")).alias("last_seen"),
        "disappeared_at",
        "first_seen_after",
        F.datediff("first_seen", "first_seen_after").cast("bigint").alias("first_seen_days"),
        F.when(F.col("disappeared_at").isNotNull(), F.datediff("disappeared_at", "last_seen").cast("bigint")).alias("disappeared_days"),
        "is_present",
        "revision_no",
        "first_source",
        "last_source",
    )


def log(rows: DataFrame, key: list[str], entries: list[tuple[Column, dict[str, Column]]]) -> DataFrame:
    """One row for each entry whose condition holds: a single scan instead of one for each kind."""
    made = [F.when(when, F.struct(*[v.alias(k) for k, v in values.items()])) for when, values in entries]
    return rows.select(*key, F.explode(F.array_compact(F.array(*made))).alias("e")).select(*key, "e.*")


def issues(records: DataFrame) -> DataFrame:
    """record_key, field, raw_value, issue of everything that is wrong with a record."""
    c = F.col

    def entry(when: Column, field: str, raw: str, issue: str) -> tuple[Column, dict[str, Column]]:
        return when, {"field": F.lit(field), "raw_value": c(raw).cast("string"), "issue": F.lit(issue)}

    return log(
        records,
        ["record_key"],
        [
            entry(c("brand").isNull() & (c("nz_method") != "empty"), "nz", "nz_raw", "brand_unresolved"),
            entry(c("homoglyph_fixed") & c("brand").isNull(), "nz", "nz_raw", "script_mixed"),
            entry(c("brand_conflict"), "brand", "nz_raw", "conflicts_with_tac"),
            entry(c("imei_norm").isNull(), "imei", "imei_raw", "imei_unusable"),
            entry(c("imei_norm").isNotNull() & ~c("imei_luhn_valid"), "imei", "imei_raw", "imei_checksum_failed"),
            entry(c("insert_date_implausible"), "insert_date", "insert_date_raw", "date_implausible"),
            entry(c("brand").isNotNull() & c("model").isNull(), "model", "nz_raw", "model_missing"),
            entry(c("region").isNull() & (F.trim("ovd") != ""), "ovd", "ovd", "region_unknown"),
        ],
    )


def changes(records: DataFrame) -> DataFrame:
    """record_key, field, value_before, value_after, reason of everything that was rewritten."""
    c = F.col
    named = F.concat_ws(" ", F.coalesce("brand", F.lit("")), c("model"))
    none = F.lit(None).cast("string")

    def entry(when: Column, field: str, before: str, after: Column, reason: Column) -> tuple[Column, dict[str, Column]]:
        return when, {"field": F.lit(field), "value_before": c(before).cast("string"), "value_after": after, "reason": reason}

    return log(
        records,
        ["record_key"],
        [
            entry(c("brand").isNotNull() & (F.upper(F.trim("nz_raw")) != named), "nz", "nz_raw", named, c("nz_method")),
            entry(c("imei_norm").isNotNull() & (c("imei_raw") != c("imei_norm")), "imei", "imei_raw", c("imei_norm"), F.when(c("imei_was_repaired"), "check_digit_restored").otherwise("reformatted")),
            entry(c("imei_norm").isNull(), "imei", "imei_raw", none, F.concat(F.lit("unusable_"), F.lower("imei_kind"))),
            entry(c("insert_date_implausible"), "insert_date", "insert_date_raw", none, F.lit("implausible_date_nulled")),
        ],
    )


def rebuild(state: DataFrame, ledger: DataFrame, aliases: DataFrame, words: dict[str, str] | None, lines: DataFrame, as_of: date, external: DataFrame | None = None, external_name: str = "external", known: DataFrame | None = None) -> dict[str, DataFrame]:
    """All derived tables from state, ledger and dictionaries: the same result however often it runs."""
    from tidemark.operators.fold import observations

    calendar = observations(ledger)
    spellings = spelling_map(state, aliases, words, known)
    units = match.regions(state)
    records = normalised(state, spellings, units, calendar, as_of)
    dictionary = consensus.build(records)
    if external is not None:
        entries = consensus.external_entries(external)
        brands = match.resolve(entries.select(F.col("brand").alias("nz_raw")), aliases, words)
        dictionary = consensus.merge_external(dictionary, entries, brands, external_name)
    published = consensus.model_key(consensus.fill(records, dictionary), lines)
    return {"observations": calendar, "spellings": spellings, "units": units, "dictionary": dictionary, "records": published, "changes": changes(published), "issues": issues(published)}
