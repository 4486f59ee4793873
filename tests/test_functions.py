import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from grantflow import dims
from grantflow.functions import dates, keys, links, mail, match, numbers, ulid


def test_mmddyyyy(one):
    values = ["01022023", "13022023", "02302023", "1022023", "", None, "0102202", "01/02/06", "010220234"]
    assert one(dates.mmddyyyy, values) == [date(2023, 1, 2)] + [None] * 8


def test_mmddyyyy_random(one):
    rng = random.Random(7)
    days = [date(1970, 1, 1) + timedelta(days=rng.randrange(40000)) for _ in range(100)]
    assert one(dates.mmddyyyy, [d.strftime("%m%d%Y") for d in days]) == days


def test_fiscal_year(one):
    years = [str(y) for y in range(1970, 2071)]
    assert one(dates.fiscal_year, years) == [date(int(y), 1, 1) for y in years]
    assert one(dates.fiscal_year, ["", "20", "20221", "20a1", "2022\n"]) == [None] * 5


def test_due_date(one):
    got = one(dates.due_date, ["5-11-23", "5/1/23", "12-31-99", "1-1-69", "1-1-68", "2023-05-11", "", "N/A", "13-1-23"])
    assert got == [
        date(2023, 5, 11), date(2023, 5, 1), date(1999, 12, 31), date(1969, 1, 1), date(2068, 1, 1),
        None, None, None, None,
    ]


def test_long_date(one):
    assert one(dates.long_date, ["April 5, 2023", "December 15, 2022", "2023-04-05"]) == [
        date(2023, 4, 5), date(2022, 12, 15), None]


@pytest.mark.parametrize("text,expected", [
    ("2.98", "02.980"), ("10.72", "10.720"), ("10.727+", "10.727"), ("81.", "81.000"), ("81.086", "81.086"),
    ("Some Act", None), ("123.4", None), ("10.7271", None), ("10.727\n", None), ("", None)])
def test_cfda_number(one, text, expected):
    assert one(numbers.cfda_number, [text]) == [expected]


def test_is_cfda(one):
    assert one(numbers.is_cfda, ["10.727", "1.727", "10.72", "1234.567", "10.727\n"]) == [
        True, False, False, False, False]


def test_amount(one):
    values = ["5000000", "N/A", "5,000", "", "-3", "+4", " 5", "5.0", "99999999999999999999", None]
    assert one(numbers.amount, values) == [5000000, 0, 0, 0, -3, 4, 0, 0, 0, 0]
    assert one(numbers.amount_is_bad, values) == [
        False, False, True, True, False, False, True, True, True, False]


def test_award_count_and_flags(one):
    assert one(numbers.award_count, ["7", "0", "-1", "x", "", None]) == [7, 0, None, None, None, None]
    assert one(numbers.yes_no, ["Yes", "NO", "yEs", "maybe", "", None]) == [True, False, True, None, None, None]
    assert one(numbers.x_mark, ["X", "N", "", "Invalid", "x", None]) == [True, False, False, False, False, False]


def test_link_id(one):
    cases = {
        "https://www.grants.gov/search-results-detail/40071": 40071,
        "https://grants.gov/search-results-detail/990001234": 990001234,
        "https://www.grants.gov/view-opportunity.html?oppId=31337": 31337,
        "https://www.grants.gov/search-results-detail/77?oppId=88": 88,
        "https://www.grants.gov/search-results-detail/77?x=1": None,
        "https://not.grants.gov/search-results-detail/5": None,
        "https://www.grants.gov/search-results-detail/abc": None,
        "https://www.grants.gov/search-results-detail/99999999999999999999?oppId=9": 9,
        "not a url at all %%": None,
        None: None,
    }
    assert one(links.link_id, list(cases)) == list(cases.values())


def test_extract_one(one):
    url = "https://mcusercontent.com/1/files/file-01.xlsx"
    got = one(links.extract_one, [f"go <{url}> now", "none here", f"<{url}>\n<{url}>", f"{url} {url}", None])
    assert [(g.url, g.status) for g in got] == [
        (url, "url"), (None, "none"), (None, "multiple"), (f"{url} {url}", "url"), (None, "none")]


def test_ulid(one):
    values = ["01H44KDRQ9EDQP2PS3X4VJHY9X", "01h44kdrq9edqp2ps3x4vjhy9x", "81H44KDRQ9EDQP2PS3X4VJHY9X",
              "01H44KDRQ9EDQP2PS3X4VJHY9", "01H44KDRQ9EDQP2PS3X4VJHYIL", "", None]
    assert one(ulid.is_ulid, values) == [True, True, False, False, False, False, False]
    millis = one(ulid.ulid_millis, values)
    assert millis[:2] == [1688076739305, 1688076739305] and millis[2:] == [None] * 5


def test_revision_id_is_stable_and_ordered(one):
    early = one(lambda c: ulid.revision_id(F.lit(1_700_000_000_000), c), ["a", "a", "b"])
    late = one(lambda c: ulid.revision_id(F.lit(1_700_000_000_001), c), ["a"])
    assert early[0] == early[1] != early[2]
    assert all(len(x) == 26 for x in early) and late[0] > max(early)
    assert one(ulid.ulid_millis, early + late) == [1_700_000_000_000] * 3 + [1_700_000_000_001]
    biggest = one(lambda c: ulid.ulid_prefix(c.cast("bigint")), [str(2**48 - 1)])
    assert biggest == ["7ZZZZZZZZZ"]


def test_keys(one):
    assert one(keys.sheet_key, ["654321", "12", "123"]) == [
        "654/654321/ffis.org/v1.json", None, "123/123/ffis.org/v1.json"]
    assert one(lambda c: keys.registry_key(c, F.lit(True)), ["3286"]) == [
        "328/3286/grants.gov/v2.OpportunityForecastDetail_1_0.xml"]
    assert one(lambda c: keys.registry_key(c, F.lit(False)), ["3286"]) == [
        "328/3286/grants.gov/v2.OpportunitySynopsisDetail_1_0.xml"]
    assert one(keys.key_problem, ["12", "123", "", None]) == ["short_id", None, "short_id", "short_id"]
    assert one(keys.download_key, ["sources/2023/04/22/ffis.org/raw.eml", "a/b"]) == [
        "sources/2023/04/22/ffis.org/download.xlsx", "a/b"]
    assert one(keys.download_key, ["ffis.org/raw.eml/ffis.org/raw.eml"]) == [
        "ffis.org/download.xlsx/ffis.org/raw.eml"]


def test_locator_and_fetch(one):
    day = one(lambda c: keys.locator(F.to_date(c), F.lit("https://x/")), ["2023-06-05"])
    assert day == ["https://x/GrantsDBExtract20230605v2.zip"]
    status = [str(s) for s in range(200, 501)]
    got = one(lambda c: keys.fetch_problem(c.cast("int"), F.lit("application/zip")), status)
    assert got == [None] + ["status"] * 300
    assert one(lambda c: keys.fetch_problem(F.lit(200), c), ["application/zip", "text/html", None]) == [
        None, "content_type", "content_type"]


def test_norm_address(one):
    got = one(mail.norm_address, ["  A.b.C+x@Example.com ", "a@b@c", "plain", "x+y+z@d"])
    assert [tuple(g) for g in got] == [
        ("abc", "example.com", "abc@example.com"), ("a", "b@c", "a@b@c"), ("plain", "", "plain@"), ("x", "d", "x@d")]


def test_matchers(one):
    keys_ = ["654/654321/ffis.org/v1.json", "654/654321/grants.gov/v2.xml",
             "654/654321/grants.gov/v2.OpportunitySynopsisDetail_1_0.xml", "x/654/654321/ffis.org/v1.json",
             "654/654321/ffis.org/v1.json.bak"]
    assert one(match.sheet_keys, keys_) == [True, False, False, False, False]
    assert one(match.registry_keys, keys_) == [False, True, True, False, False]
    # a full match even when the first branch is a prefix of the second
    assert one(match.regex_matcher("ab|abc"), ["abc", "ab", "abcd"]) == [True, True, False]
    assert one(match.glob_matcher("a/*/[bc]?.x"), ["a/q/b1.x", "a/q/r/b1.x", "a/q/d1.x", "a//c1.x"]) == [
        True, False, False, True]
    either = lambda c: match.any_of(c, [match.sheet_keys, match.registry_keys], "654/")
    assert one(either, keys_) == [True, True, True, False, False]
    with pytest.raises(ValueError):
        match.any_of(F.lit("k"), [])
    with pytest.raises(ValueError):
        match.glob_regex("a[b")


def test_dimensions(spark):
    assert [len(d) for d in dims.DIMENSIONS.values()] == [17, 26, 4, 5]
    for codes in dims.DIMENSIONS.values():
        assert dims.inverse(dims.inverse(codes)) == codes
    with pytest.raises(ValueError):
        dims.inverse({"a": "x", "b": "x"})
    assert dims.dimension_table(spark, "instrument").count() == 4


def test_sent_at(one):
    got = one(mail.sent_at, ["Sat, 22 Apr 2023 14:55:26 -0500", "22 Apr 2023 14:55 +0000 (UTC)",
                             "Sat, 22 Apr 2023 14:55:26 GMT", "yesterday", ""])
    assert got == [datetime(2023, 4, 22, 19, 55, 26), datetime(2023, 4, 22, 14, 55),
                   datetime(2023, 4, 22, 14, 55, 26), None, None]
    assert one(mail.sent_day, ["Sat, 22 Apr 2023 23:55:26 -0500", "x"]) == [date(2023, 4, 22), None]


def test_sender(one):
    got = one(mail.sender, ["Some Person <some.person@example.org>", "a@b.c", "<a@b.c>", '"Doe, J" <j@d.e>',
                            "nobody", "", "a@b.c, d@e.f"])
    assert got == ["some.person@example.org", "a@b.c", "a@b.c", "j@d.e", None, None, None]


def test_long_texts_need_no_stack(spark):
    from grantflow.sources.registry_xml import parse_chunks
    million = 1_000_000
    chunks = spark.createDataFrame([
        ("f", 0, 0, " " * million), ("f", 0, 1, "<!-- " + "x" * million + " -->\n<Grants>"), ("f", 0, 2, "<" * million),
        ("f", 0, 3, "<?xml?>\n" * 100_000 + "<ns:Grants a='1'>"),
    ], "file string, split int, ord int, chunk string")
    good, rejects = parse_chunks(chunks)
    assert good.count() == 0 and [r.ord for r in rejects.collect()] == [2]
    heads = ["A: b\n" * (million // 5) + "C: d", "A: b\n" * (million // 5) + "no header", "A" * million + ": b"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i int, h string")
    assert [r.m for r in df.select("i", mail.is_message(F.col("h")).alias("m")).orderBy("i").collect()] == [True, False, True]
    senders = ['"' + "n" * million + '" <a@b.c>', '"' + "\\\"" * (million // 2) + '" <a@b.c>', "n" * million]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(senders)], "i int, s string")
    assert [r.a for r in df.select("i", mail.sender(F.col("s")).alias("a")).orderBy("i").collect()] == ["a@b.c", "a@b.c", None]


def test_prefixed_records(spark):
    from grantflow.sources.registry_xml import parse_chunks
    body = "<p:OpportunityID>4711</p:OpportunityID><p:LastUpdatedDate>02062024</p:LastUpdatedDate></p:OpportunitySynopsisDetail"
    chunks = spark.createDataFrame(
        [("f", 0, 0, "<p:Grants><p:OpportunitySynopsisDetail"), ("f", 0, 1, ">" + body), ("f", 0, 2, "</p:Grants>")],
        "file string, split int, ord int, chunk string")
    good, rejects = parse_chunks(chunks.withColumn("chunk", F.regexp_replace("chunk", "^>", "")))
    assert [(r.grant_id, r.LastUpdatedDate) for r in good.collect()] == [("4711", "02062024")] and rejects.count() == 0
