"""Metrics, aggregates, volumes and rendered reports over the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivoted(df: DataFrame, metrics: dict[str, Column], distinct: dict[str, str] | None = None) -> DataFrame:
    """metric, value: all metrics from one aggregation, turned into rows.

    Distinct counts are done one column at a time beside it, because several in
    one aggregation would multiply the rows.
    """
    pairs = ", ".join(f"'{n}', m{i}" for i, n in enumerate(metrics))
    out = df.agg(*[c.cast("bigint").alias(f"m{i}") for i, c in enumerate(metrics.values())]).selectExpr(f"stack({len(metrics)}, {pairs}) as (metric, value)")
    for name, column in (distinct or {}).items():
        out = out.unionByName(df.agg(F.count_distinct(column).alias("value")).select(F.lit(name).alias("metric"), "value"))
    return out


def quality_metrics(records: DataFrame) -> DataFrame:
    """The 14 headline metrics of the published table."""
    c = F.col
    return unpivoted(
        records,
        {
            "records_total": F.count(F.lit(1)),
            "records_present": F.count_if("is_present"),
            "records_disappeared": F.count("disappeared_at"),
            "brand_resolved": F.count("brand"),
            "model_resolved": F.count("model"),
            "homoglyph_fixed": F.count_if("homoglyph_fixed"),
            "imei_usable": F.count("imei_norm"),
            "imei_luhn_valid": F.count_if("imei_luhn_valid"),
            "imei_repaired": F.count_if("imei_was_repaired"),
            "imei_invalid": F.count_if(c("imei_kind") == "INVALID"),
            "insert_date_implausible": F.count_if("insert_date_implausible"),
        },
        {"distinct_tac": "tac", "distinct_brand": "brand", "distinct_nz_raw": "nz_raw"},
    )


def unmatched(records: DataFrame, limit: int = 200) -> DataFrame:
    """The most frequent spellings without a brand: a top-k report, ties by spelling."""
    rows = records.where("brand is null and nz_method <> 'empty' and nz_raw is not null")
    return rows.groupBy("nz_raw", "nz_clean").agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("records"), "nz_raw").limit(limit)


def by_year(records: DataFrame, day: str = "insert_date") -> DataFrame:
    return records.where(F.col(day).isNotNull()).groupBy(F.trunc(day, "YEAR").alias("period")).agg(F.count(F.lit(1)).alias("records"), F.count("brand").alias("with_brand")).orderBy("period")


def by_brand(records: DataFrame) -> DataFrame:
    rows = records.where("brand is not null").groupBy("brand")
    share = F.round(100.0 * F.count_if("imei_luhn_valid") / F.count(F.lit(1)), 2)
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("tac").alias("tacs"), share.alias("luhn_pct")).orderBy(F.desc("records"), "brand")


def by_unit(records: DataFrame) -> DataFrame:
    rows = records.where("ovd is not null and insert_date is not null").groupBy("ovd")
    return rows.agg(F.count(F.lit(1)).alias("records"), F.min("insert_date").cast("date").alias("first_record"), F.max("insert_date").cast("date").alias("last_record")).orderBy(F.desc("records"), "ovd")


def closures(records: DataFrame) -> DataFrame:
    return records.where("disappeared_at is not null").groupBy(F.col("disappeared_at").alias("period")).agg(F.count(F.lit(1)).alias("closed")).orderBy("period")


def monthly_coverage(calendar: DataFrame, first_seen: DataFrame) -> DataFrame:
    """One row a month from the first to the last reading, unread months included; ``first_seen`` has a column of that name."""
    span = calendar.agg(F.trunc(F.min("snapshot_date"), "MM").alias("a"), F.trunc(F.max("snapshot_date"), "MM").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("period"))
    seen = calendar.groupBy(F.trunc("snapshot_date", "MM").alias("period")).agg(F.count(F.lit(1)).alias("days_observed"), F.max("days_since_previous").alias("longest_gap_days"))
    entered = first_seen.where("first_seen is not null").groupBy(F.trunc("first_seen", "MM").alias("period")).agg(F.count(F.lit(1)).alias("first_seen_here"))
    rows = months.join(seen, "period", "left").join(entered, "period", "left")
    days = F.coalesce("days_observed", F.lit(0)).cast("bigint")
    length = F.datediff(F.add_months("period", 1), "period").cast("bigint")
    return rows.select("period", days.alias("days_observed"), length.alias("days_in_month"), F.round(100.0 * days / length, 1).alias("coverage_pct"), "longest_gap_days", F.coalesce("first_seen_here", F.lit(0)).cast("bigint").alias("first_seen_here"), (days > 0).alias("is_measured")).orderBy("period")


def volume(ledger: DataFrame) -> DataFrame:
    """What was published, moved and dropped: one aggregation over the ledger."""
    folded = F.coalesce("status", F.lit("folded")) == "folded"
    status = lambda s: F.count_if(F.col("status") == s)
    return ledger.agg(
        F.count(F.lit(1)).alias("revisions"),
        F.count_if(folded).alias("folded"),
        status("duplicate").alias("duplicate"),
        status("skipped").alias("skipped"),
        status("failed").alias("failed"),
        F.sum("bytes").alias("bytes_published"),
        F.sum(F.when(folded, F.col("bytes"))).alias("bytes_downloaded"),
        F.sum(F.when(F.col("status") == "duplicate", F.col("bytes"))).alias("bytes_not_fetched"),
        F.sum("rows_raw").alias("rows_read"),
        F.sum("rows_dupe_id").alias("rows_dropped_dupe_id"),
        F.sum("rows_repaired").alias("rows_repaired"),
        F.count_if(F.col("read_mode") == "repaired").alias("files_repaired"),
        F.min("snapshot_date").alias("first_date"),
        F.max("snapshot_date").alias("last_date"),
    )


def human(n: float, lang: str = "en") -> str:
    """A size in readable units."""
    units = {"en": ("B", "kB", "MB", "GB", "TB"), "uk": ("Б", "кБ", "МБ", "ГБ", "ТБ")}[lang]
    i = 0
    while abs(n) >= 1000 and i < len(units) - 1:
        n, i = n / 1000, i + 1
    return f"{n:.0f} {units[i]}" if i == 0 else f"{n:.2f} {units[i]}"


def review(metrics: dict[str, int], spellings: list[tuple[str, str, int]], lang: str = "en") -> str:
    """The review of unresolved spellings as Markdown, in English or Ukrainian."""
    text = {
        "en": ("Unresolved spellings", "Records", "Brand resolved", "Model resolved", "Spelling", "Cleaned"),
        "uk": ("Нерозпізнані написання", "Записів", "Марку визначено", "Модель визначено", "Написання", "Очищене"),
    }[lang]
    total = max(1, metrics["records_total"])
    lines = [f"# {text[0]}", "", f"- {text[1]}: {metrics['records_total']:,}", f"- {text[2]}: {metrics['brand_resolved'] / total:.2%}", f"- {text[3]}: {metrics['model_resolved'] / total:.2%}", "", f"| {text[4]} | {text[5]} | {text[1]} |", "|---|---|---:|"]
    lines += ["| " + " | ".join((raw.replace("|", "\\|"), clean, f"{n:,}")) + " |" for raw, clean, n in spellings]
    return "\n".join(lines) + "\n"


def to_html(title: str, rows: list[dict], lang: str = "en") -> str:
    """A small page with one table."""
    import html

    heads = list(rows[0]) if rows else []
    cell = lambda tag, v: f"<{tag}>{html.escape(str(v))}</{tag}>"
    body = "".join("<tr>" + "".join(cell("td", r[h]) for h in heads) + "</tr>" for r in rows)
    return f'<!doctype html><html lang="{lang}"><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{"".join(cell("th", h) for h in heads)}</tr>{body}</table></html>'
