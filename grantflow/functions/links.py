"""Grant ids from cell hyperlinks, and urls from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantflow.functions.numbers import strict_bigint

# Hosts and path shape of a link to an opportunity.
LINK_HOSTS = ("grants.gov", "www.grants.gov")
LINK_PATH = r"^/search-results-detail/[0-9]+\z"
# Fixed value: shape of the download link in a notification mail.
DOWNLOAD_URL = r"https://mcusercontent.com/.+\.xlsx"


def link_id(link: Column, hosts=LINK_HOSTS, path: str = LINK_PATH, param: str = "oppId") -> Column:
    """Id after the last slash of a path-style link, else the id in the query string.

    ``hosts=None`` takes links to any host.
    """
    host = F.try_parse_url(link, F.lit("HOST"))
    in_path = F.when(
        F.try_parse_url(link, F.lit("PATH")).rlike(path),
        strict_bigint(F.substring_index(link, "/", -1)),
    )
    in_query = strict_bigint(F.try_parse_url(link, F.lit("QUERY"), F.lit(param)))
    found = F.coalesce(in_path, in_query)
    return found if hosts is None else F.when(host.isin(*hosts), found)


def extract_one(text: Column, pattern: str = DOWNLOAD_URL) -> Column:
    """struct(url, status): exactly one match is a url, any other count is a status."""
    # (?d): only a line feed ends what a dot matches
    found = F.regexp_extract_all(text, F.lit("(?d)" + pattern), F.lit(0))
    n = F.coalesce(F.size(found), F.lit(0))
    status = F.when(n <= 0, "none").when(n == 1, "url").otherwise("multiple")
    return F.struct(F.when(n == 1, F.element_at(found, 1)).alias("url"), status.alias("status"))
