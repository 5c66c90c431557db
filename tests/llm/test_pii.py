import datetime
import re

import pytest
from pyspark.sql import functions as F

from loanlens.llm import pii


def luhn(digits):
    total = 0
    for place, character in enumerate(reversed(digits)):
        d = int(character) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(text):
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


@pytest.fixture
def changed(spark):
    def run(texts, key="key"):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
        return [r["text"] for r in pii.pseudonymized(rows, key).orderBy("i").collect()]

    return run


FORMS = {
    "card 4111 1111 1111 1111.": r"card \d{4} \d{4} \d{4} \d{4}\.",
    "4111111111111111!!": r"\d{16}!!",
    "call +1 (017) 555-7713 now": r"call \+1 \(\d{3}\) \d{3}-\d{4} now",
    "(212) 555-0187": r"\(\d{3}\) \d{3}-\d{4}",
    "at 10.0.0.255, yes": r"at \d+\.\d+\.\d+\.\d+, yes",
    "ssn 123-45-6789": r"ssn \d{3}-\d{2}-\d{4}",
    "born 1987-03-12": r"born \d{4}-\d{2}-\d{2}",
    "born 12.03.1987": r"born \d{2}\.\d{2}\.\d{4}",
    "born 03/12/1987": r"born \d{2}/\d{2}/\d{4}",
    "DE89370400440532013000": r"DE\d{20}",
    "GB29 NWBK 6016 1331 9268 19": r"GB\d\d NWBK \d{4} \d{4} \d{4} \d\d",
    "mail und.34@mail7.example.com!": r"mail u[0-9a-f]{16}@example\.invalid!",
}
KEPT = ["", "plain words 123", "4111111111111112", "1234-56", "300.1.2.3", "000-12-3456", "666-12-3456", "1987-02-30", "2150-01-01",
        "DE00370400440532013000", "1.2.3.4.5", "x4111111111111111", None]


def test_forms_and_validity(changed):
    got = dict(zip(FORMS, changed(list(FORMS)), strict=True))
    for text, form in FORMS.items():
        assert got[text] != text and re.fullmatch(form, got[text]), (text, got[text])
    assert luhn(re.sub(r"\D", "", got["card 4111 1111 1111 1111."]))
    assert re.sub(r"\D", "", got["card 4111 1111 1111 1111."]) == got["4111111111111111!!"][:16]
    datetime.date.fromisoformat(got["born 1987-03-12"][5:])
    for text in ("DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"):
        assert mod97(got[text].replace(" ", "")) == 1
    assert all(int(o) < 256 for o in re.findall(r"\d+", got["at 10.0.0.255, yes"]))


def test_what_is_not_valid_stays(changed):
    assert changed(KEPT) == KEPT


def test_same_value_same_pseudonym_and_key_matters(changed):
    a, b = changed(["x 4111111111111111 y 4111111111111111", "4111111111111111"])
    assert a == f"x {b} y {b}"
    assert changed(["4111111111111111"], "other")[0] != b


def test_permutation(spark):
    """All values of a small format: no two share a pseudonym, none leaves the format."""
    names = pii.Pseudonyms("key")
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("n"))
    assert numbers.select(names.digits(F.col("n"), "t").alias("p")).distinct().where("p rlike '^[0-9]{3}$'").count() == 1000
    days = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    made = days.select(names.date(F.col("d"), "yyyy-MM-dd").alias("p")).distinct()
    assert made.where("p between '1900-01-01' and '2099-12-31'").count() == 73049


def test_slash_dates_are_one_permutation(spark):
    """All 117,298 written days: a day after the twelfth can be written first, and no two share a pseudonym."""
    start, names = F.lit("1900-01-01").cast("date"), pii.Pseudonyms("key")
    day = spark.range(73049).select(F.date_add(start, F.col("id").cast("int")).alias("day"))
    forms = day.select(F.date_format("day", "MM/dd/yyyy").alias("d")).union(day.where("day(day) > 12").select(F.date_format("day", "dd/MM/yyyy")))
    written = forms.collect()
    made = forms.select(names.slash_date(F.col("d")).alias("p")).collect()
    assert len(written) == 117_298 and {r["p"] for r in made} == {r["d"] for r in written}
    stay = spark.createDataFrame([("13/13/2000",), ("02/30/2000",), ("00/10/2000",), ("01/01/1899",), ("31/12/2100",)], "d string")
    assert all(r["d"] == r["p"] for r in stay.select("d", names.slash_date(F.col("d")).alias("p")).collect())


def test_long_texts(changed):
    text = "a" * 300_000 + " " + "1" * 200_000 + " 4111111111111111"
    (got,) = changed([text])
    assert got[:-16] == text[:-16] and got != text
