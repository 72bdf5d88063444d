"""Device identifiers: digits, checksum, canonical form and parts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digits_of(raw: Column) -> Column:
    """The ASCII digits of a text; null gives the empty text."""
    return F.regexp_replace(F.coalesce(raw, F.lit("")), "[^0-9]", "")


def check_digit_of(fourteen: Column) -> Column:
    """Check digit of the first 14 digits: every second digit is doubled and its digits added."""
    digit = lambda i: F.substring(fourteen, i, 1).cast("int")
    total = digit(1)
    for i in range(2, 15):  # written out, so that it stays inside generated code
        total = total + (digit(i) if i % 2 else digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    return F.when(F.length(fourteen) >= 14, (10 - total % 10) % 10)


def checksum_valid(fifteen: Column) -> Column:
    """Whether 15 digits end in their own check digit; null stays null, other lengths are false."""
    return F.when(fifteen.isNotNull(), F.coalesce((F.length(fifteen) == 15) & F.call_function("luhn_check", fifteen), F.lit(False)))


def canonical(raw: Column) -> Column:
    """15 digits, or null: 14 and 16 digits get a computed check digit, 17 and 18 lose their tail; all-equal digits and a leading 00 are refused."""
    d = digits_of(raw)
    n = F.length(d)
    usable = (d != "") & ~d.startswith("00") & ~d.rlike(r"^(.)\1*$")
    with_check = F.concat(F.substring(d, 1, 14), check_digit_of(F.substring(d, 1, 14)).cast("string"))
    return F.when(usable & n.isin(14, 16), with_check).when(usable & n.isin(15, 17, 18), F.substring(d, 1, 15))


#: The columns that ``with_parts`` adds.
PARTS = ("imei_digits", "imei_norm", "imei_was_repaired", "imei_kind", "tac", "rbi", "tac_legacy", "fac", "snr", "check_digit", "imei_luhn_valid")


def with_parts(rows: DataFrame, raw: str) -> DataFrame:
    """``rows`` with all derived columns of an identifier, each worked out once: its digits, its 15 digits, then the rest.

    Unlike ``canonical`` this keeps identifiers of one repeated digit, as the
    published table does.
    """
    held = "imei_digit_text"
    while held in rows.columns:
        held += "_"
    d, n = F.col(held), F.length(held)
    usable = F.col(raw).isNotNull() & (d != "") & ~d.startswith("00")
    with_check = F.concat(F.substring(d, 1, 14), check_digit_of(d).cast("string"))
    out = rows.withColumn(held, digits_of(F.col(raw)))
    out = out.withColumns({"imei_digits": F.when(F.col(raw).isNotNull(), n), "imei_norm": F.when(usable & n.isin(14, 16), with_check).when(usable & n.isin(15, 17, 18), F.substring(d, 1, 15))})
    norm, n = F.col("imei_norm"), F.col("imei_digits")
    return out.drop(held).withColumns(
        {
            "imei_was_repaired": F.when(norm.isNotNull(), n.isin(14, 16)),
            "imei_kind": F.when(norm.isNull() & n.between(8, 13), "SERIAL").when(norm.isNull(), "INVALID").when(n == 16, "IMEISV").otherwise("IMEI"),
            "tac": F.substring(norm, 1, 8),
            "rbi": F.substring(norm, 1, 2),
            "tac_legacy": F.substring(norm, 1, 6),
            "fac": F.substring(norm, 7, 2),
            "snr": F.substring(norm, 9, 6),
            "check_digit": F.substring(norm, 15, 1),
            "imei_luhn_valid": checksum_valid(norm),
        }
    )
