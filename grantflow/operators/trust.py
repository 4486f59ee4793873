"""Which mails may be trusted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.functions.mail import norm_address
from grantflow.operators.skew import lookup_join


def allowed(address: Column, allow_list: list[str]) -> Column:
    """Entries with an @ are addresses, others are domains; one match is enough."""
    own = norm_address(address)
    entries = [e.strip().lower() for e in allow_list]
    full = [norm_address(F.lit(e))["complete"] for e in entries if "@" in e]
    domains = [F.lit(e) for e in entries if "@" not in e]
    hit = F.lit(False)
    if full:
        hit = hit | own["complete"].isin(*full)
    if domains:
        hit = hit | own["domain"].isin(*domains)
    return hit


def allowed_senders(mail: DataFrame, allow: DataFrame, sender: str = "sender") -> DataFrame:
    """Distinct senders that a table of entries (column ``entry``) allows.

    Senders are made distinct first, so a sender or domain with very many mails is one row here.
    """
    def keys(address: Column, domain: Column) -> Column:
        return F.explode(F.array(
            F.struct(F.lit("address").alias("kind"), address.alias("value")),
            F.struct(F.lit("domain").alias("kind"), domain.alias("value")),
        )).alias("key")

    own = norm_address(F.col(sender))
    people = mail.select(sender).where(F.col(sender).isNotNull()).distinct()
    people = people.select(sender, keys(own["complete"], own["domain"]))
    entry = F.lower(F.trim("entry"))
    is_address = F.instr(entry, "@") > 0
    entries = allow.select(keys(
        F.when(is_address, norm_address(entry)["complete"]), F.when(~is_address, entry)
    )).where("key.value IS NOT NULL")
    return people.join(entries, "key", "left_semi").select(sender).distinct()


def verdict(sender_ok: Column, spf: Column, spam: Column, virus: Column) -> Column:
    """First failing check, or ``trusted``."""
    blank = F.lit("")
    return (
        F.when(~F.coalesce(sender_ok, F.lit(False)), "sender")
        .when(~F.coalesce(spf, blank).startswith("pass"), "spf")
        .when(F.coalesce(spam, blank) != "PASS", "spam")
        .when(F.coalesce(virus, blank) != "PASS", "virus")
        .otherwise("trusted")
    )


def classify_mail(
    parsed: DataFrame, allow: list[str] | DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Adds ``verdict`` to parsed mail; mail that could not be parsed keeps its parse error."""
    if isinstance(allow, DataFrame):
        senders = allowed_senders(parsed, allow).withColumn("_ok", F.lit(True))
        judged = lookup_join(parsed, senders, "sender", "left", hot)
    else:
        judged = parsed.withColumn("_ok", allowed(F.col("sender"), allow))
    outcome = F.coalesce(
        F.col("parse_error"),
        verdict(F.col("_ok"), F.col("spf"), F.col("spam"), F.col("virus")),
    )
    return judged.withColumn("verdict", outcome).drop("_ok")
