"""Mail headers, addresses and MIME parts as expressions over the message text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantflow.frames import let

_ADDRESS = r"[^<>@\s,;\"]+@[^<>@\s,;\"]+"
# a quoted name is looked at as a whole: backslash pairs are taken out of it first
_SENDER = rf"^(?:(?:\"[^\"]*+\"|[^\"<>@,]*+)\s*+<({_ADDRESS})>|({_ADDRESS}))\z"
_PART_MARK = "\x01"


def normal_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def _head(flat: Column) -> Column:
    end = F.instr(flat, "\n\n")
    block = F.substring(flat, F.lit(1), end - 1)
    return F.when(end > 1, F.regexp_replace(block, r"\n[ \t]+", " "))


def head(text: Column) -> Column:
    """Header block with folded lines joined; NULL when no blank line ends it."""
    return _head(normal_newlines(text))


def split_message(text: Column) -> Column:
    """struct(head, body) at the first blank line; both NULL when there is none."""
    def parts(flat: Column) -> Column:
        end = F.instr(flat, "\n\n")
        body = F.when(end > 0, F.substring(flat, end + 2, F.length(flat)))
        return F.struct(_head(flat).alias("head"), body.alias("body"))

    return let(normal_newlines(text), parts)


def is_message(head_text: Column) -> Column:
    """Every header line is ``Name: value``."""
    odd = F.filter(F.split(head_text, "\n"), lambda line: ~line.rlike(r"^[!-9;-~]++[ \t]*+:"))
    return F.coalesce(F.size(odd) == 0, F.lit(False))


def header(head_text: Column, name: str) -> Column:
    """First value of a header, blank when absent."""
    return F.regexp_extract(head_text, rf"(?im)^{name}:[ \t]*([^\n]*?)[ \t]*$", 1)


def sender(from_header: Column) -> Column:
    """Address of ``Name <a@b>`` or ``a@b``; NULL when the header is neither."""
    text = F.regexp_replace(F.trim(from_header), r"(?s)\\.", "")
    found = F.coalesce(
        F.nullif(F.regexp_extract(text, _SENDER, 1), F.lit("")),
        F.nullif(F.regexp_extract(text, _SENDER, 2), F.lit("")),
    )
    return found


def sent_text(date_header: Column) -> Column:
    """Date header without weekday and comment, zone names given as offsets."""
    plain = F.regexp_replace(F.trim(date_header), r"^[A-Za-z]{3},\s*", "")
    plain = F.regexp_replace(plain, r"\s*\([^)]*\)\z", "")
    plain = F.regexp_replace(plain, r"\s+[A-Z]{1,4}\z", " +0000")
    return F.regexp_replace(plain, r"\s+", " ")


def sent_at(date_header: Column) -> Column:
    text = sent_text(date_header)
    return F.coalesce(*[
        F.try_to_timestamp(text, F.lit(layout))
        for layout in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z")
    ])


def sent_day(date_header: Column) -> Column:
    """Calendar day in the sender's own zone."""
    day = F.regexp_extract(sent_text(date_header), r"^([0-9]{1,2} [A-Za-z]{3} [0-9]{4}) ", 1)
    return F.try_to_date(day, "d MMM yyyy")


def norm_address(address: Column) -> Column:
    """struct(name, domain, complete) in comparable form."""
    text = F.lower(F.trim(address))
    name = F.replace(F.regexp_extract(text, r"^([^@+]*)", 1), F.lit("."), F.lit(""))
    domain = F.when(F.instr(text, "@") > 0, F.regexp_extract(text, r"@(?s)(.*)\z", 1)).otherwise("")
    return F.struct(
        name.alias("name"), domain.alias("domain"), F.concat(name, F.lit("@"), domain).alias("complete")
    )


def _decoded(part_head: Column, part_body: Column) -> Column:
    """Undo quoted-printable: soft breaks go, ``=XX`` bytes become text."""
    joined = F.regexp_replace(part_body, r"=[ \t]*\n", "")
    escaped = F.replace(F.replace(joined, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    decoded = F.try_url_decode(F.regexp_replace(escaped, r"=([0-9A-Fa-f]{2})", "%$1"))
    encoding = F.lower(header(part_head, "Content-Transfer-Encoding"))
    return F.when(encoding == "quoted-printable", F.coalesce(decoded, part_body)).otherwise(part_body)


def plain_part(text: Column) -> Column:
    """struct(text, status) of the first text/plain part of a multipart/alternative message."""
    def first_plain(message: Column, mark: Column) -> Column:
        pieces = F.split(
            F.replace(
                F.concat(F.lit("\n"), message["body"]), F.concat(F.lit("\n--"), mark),
                F.lit(_PART_MARK),
            ),
            _PART_MARK,
        )
        # what precedes the first mark is preamble; a piece starting with -- closes the message
        inner = F.filter(pieces, lambda p, i: (i > 0) & ~p.startswith("--"))
        parts = F.transform(inner, lambda p: split_message(F.regexp_replace(p, r"^[ \t]*\n", "")))
        return F.get(
            F.filter(parts, lambda p: header(p["head"], "Content-Type").startswith("text/plain")), 0
        )

    def judged(message: Column) -> Column:
        kind = header(message["head"], "Content-Type")
        media = F.lower(F.trim(F.substring_index(kind, ";", 1)))
        mark = F.coalesce(
            F.nullif(F.regexp_extract(kind, r"(?i)boundary=\"([^\"]+)\"", 1), F.lit("")),
            F.nullif(F.regexp_extract(kind, r"(?i)boundary=([^\s;\"]+)", 1), F.lit("")),
        )

        def result(plain: Column) -> Column:
            status = (
                F.when(~is_message(message["head"]), "message")
                .when(media != "multipart/alternative", "not_multipart")
                .when(plain.isNull(), "no_plaintext")
                .otherwise("ok")
            )
            return let(status, lambda s: F.struct(
                F.when(s == "ok", _decoded(plain["head"], plain["body"])).alias("text"),
                s.alias("status"),
            ))

        return let(first_plain(message, mark), result)

    return let(split_message(text), judged)
