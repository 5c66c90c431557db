"""Personal numbers and dates replaced by keyed pseudonyms of the same format.

A Feistel network permutes the values of a format among themselves: card numbers stay valid card
numbers, dates stay dates, and equal values get equal pseudonyms in every document. All of it is
column expressions; nothing is looked up, collected or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import ROW, carried

ROUNDS = 10

# The written forms that are looked for. A match that fails its validation stays.
LEFT, RIGHT = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
IBAN = LEFT + r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)" + RIGHT
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|\+[0-9]{8,15}"
    r"|\+[0-9]{1,3}(?:[ -][0-9]{2,4}){2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])"
)
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
DATE = (
    r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    r"|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-])"
)
CARD = LEFT + r"(?:[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{1,7}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})" + RIGHT
ANY = "|".join([EMAIL, IBAN, PHONE, IPV4, SSN, DATE, CARD])

#: Dates of 1900 to 2099: 73,049 days, as 17 x 4,297.
FIRST_DAY, DAY_PARTS = "1900-01-01", (17, 4297)
#: Written ``99/99/9999``: those days with the month first, and the 44,249 later than the twelfth with the day first; 446 x 263.
SLASH_PARTS, DAYS = (446, 263), 73_049
#: Social security numbers: areas 001-899 but 666 with groups 01-99, and serials 0001-9999.
SSN_PARTS = (898 * 99, 9999)


def _long(value: Column) -> Column:
    return value.cast("long")


def _power(digits: Column) -> Column:
    """10 to the number of digits (at most 18)."""
    return _long(F.element_at(F.array(*[F.lit(10**n) for n in range(19)]), (digits + 1).cast("int")))


class Pseudonyms:
    """The permutations under one key. Each method maps a text column of one format to itself."""

    def __init__(self, key: str):
        self.key = key

    def _feistel(self, left: Column, right: Column, lefts: Column, rights: Column, kind: str) -> tuple[Column, Column]:
        """Permute pairs (left < lefts, right < rights); alternate rounds shift one by a keyed digest of the other."""

        def step(state: Column, turn: Column) -> Column:
            even = turn % 2 == 0
            seen = F.when(even, state.r).otherwise(state.l).cast("string")
            digest = F.sha2(F.concat_ws("|", F.lit(self.key), F.lit(kind), lefts.cast("string"), turn.cast("string"), seen), 256)
            shift = _long(F.conv(F.substring(digest, 1, 15), 16, 10))
            return F.struct(
                F.when(even, (state.l + shift % lefts) % lefts).otherwise(state.l).alias("l"),
                F.when(even, state.r).otherwise((state.r + shift % rights) % rights).alias("r"),
            )

        start = F.struct(_long(left).alias("l"), _long(right).alias("r"))
        end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
        return end.l, end.r

    def digits(self, text: Column, kind: str) -> Column:
        """Permute the strings of as many digits (2 to 36)."""
        size = F.length(text)
        front = F.floor(size / 2).cast("int")
        back = size - front
        left, right = self._feistel(
            F.substring(text, F.lit(1), front), F.substring(text, front + 1, back), _power(front), _power(back), kind
        )
        return F.concat(F.lpad(left.cast("string"), front, "0"), F.lpad(right.cast("string"), back, "0"))

    def card(self, match: Column) -> Column:
        """All digits but the last are permuted and the check digit is made anew; a wrong one means no card."""
        found = _digits(match)
        payload = self.digits(F.substring(found, F.lit(1), F.length(found) - 1), "card")
        check = (10 - _luhn(F.concat(payload, F.lit("0"))) % 10) % 10
        return F.when(_luhn(found) % 10 == 0, _laid_out(match, F.concat(payload, check.cast("string")))).otherwise(match)

    def phone(self, match: Column) -> Column:
        """The country code stays, or the first digit where it is not set off."""
        found = _digits(match)
        code = F.regexp_extract(match, r"^\+([0-9]{1,3})(?=[^0-9])", 1)
        kept = F.when(code != "", code).when(match.startswith("+"), F.substring(found, 1, 1)).otherwise(F.lit(""))
        rest = F.substring(found, F.length(kept) + 1, F.length(found))
        changed = _laid_out(match, F.concat(kept, self.digits(rest, "phone")))
        return F.when(F.length(found).between(8, 15), changed).otherwise(match)

    def ipv4(self, match: Column) -> Column:
        octets = F.transform(F.split(match, r"\."), lambda o: o.cast("int"))
        at = lambda n: F.element_at(octets, n)
        left, right = self._feistel(at(1) * 256 + at(2), at(3) * 256 + at(4), _long(F.lit(65536)), _long(F.lit(65536)), "ipv4")
        parts = [F.floor(left / 256), left % 256, F.floor(right / 256), right % 256]
        made = F.concat_ws(".", *[_long(p).cast("string") for p in parts])
        return F.when(F.array_max(octets) <= 255, made).otherwise(match)

    def ssn(self, match: Column) -> Column:
        area, group, serial = (F.substring(match, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
        valid = (area != 0) & (area != 666) & (area < 900) & (group != 0) & (serial != 0)
        place = area - 1 - (area > 666).cast("int")
        areas, serials = (_long(F.lit(n)) for n in SSN_PARTS)
        left, right = self._feistel(place * 99 + group - 1, serial - 1, areas, serials, "ssn")
        shown = F.floor(left / 99) + 1
        shown = shown + (shown >= 666).cast("int")
        pad = lambda value, n: F.lpad(_long(value).cast("string"), n, "0")
        return F.when(valid, F.concat_ws("-", pad(shown, 3), pad(left % 99 + 1, 2), pad(right + 1, 4))).otherwise(match)

    def date(self, match: Column, form: str) -> Column:
        """Real days of 1900 to 2099 in this form; others stay."""
        day = F.try_to_date(match, form)
        since = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        lefts, rights = (_long(F.lit(n)) for n in DAY_PARTS)
        left, right = self._feistel(F.floor(since / DAY_PARTS[1]), since % DAY_PARTS[1], lefts, rights, "date")
        made = F.date_add(F.lit(FIRST_DAY).cast("date"), (left * DAY_PARTS[1] + right).cast("int"))
        return F.when(since.between(0, DAY_PARTS[0] * DAY_PARTS[1] - 1), F.date_format(made, form)).otherwise(match)

    def slash_date(self, match: Column) -> Column:
        """Real days of 1900 to 2099 as ``99/99/9999``: the month first, or the day if it is later than the twelfth.

        Both ways of writing share one form, so they share one permutation: places 0 to DAYS - 1 are
        the days with the month first, the places from DAYS on the days after the twelfth of a month.
        """
        day_first = F.substring(match, 1, 2).cast("int") > 12
        day = F.when(day_first, F.try_to_date(match, "dd/MM/yyyy")).otherwise(F.try_to_date(match, "MM/dd/yyyy"))
        start = F.lit(FIRST_DAY).cast("date")
        since = F.datediff(day, start)
        months = (F.year(day) - 1900) * 12 + F.month(day)  # each with twelve days that are left out
        place = F.when(day_first, DAYS + since - 12 * months).otherwise(since)
        lefts, rights = (_long(F.lit(n)) for n in SLASH_PARTS)

        def shown(made: Column) -> Column:
            rest = made - DAYS
            # the month in which the rest lies: about 18.4 days a month, at most one month off
            about = F.floor(rest * 2400 / (SLASH_PARTS[0] * SLASH_PARTS[1] - DAYS)).cast("int")
            before = lambda month: F.datediff(F.add_months(start, month), start) - 12 * month
            month = F.greatest(*[F.when((m >= 0) & (before(m) <= rest), m).otherwise(0) for m in (about - 1, about, about + 1)])
            late = _let(month, lambda m: F.date_add(F.add_months(start, m), rest - before(m) + 12))
            return F.when(made < DAYS, F.date_format(F.date_add(start, made), "MM/dd/yyyy")).otherwise(F.date_format(late, "dd/MM/yyyy"))

        def permuted(place: Column) -> Column:
            left, right = self._feistel(F.floor(place / SLASH_PARTS[1]), place % SLASH_PARTS[1], lefts, rights, "slash date")
            return (left * SLASH_PARTS[1] + right).cast("int")

        return F.when(since.between(0, DAYS - 1), _let(_let(place, permuted), shown)).otherwise(match)

    def iban(self, match: Column) -> Column:
        """The digits after country and check digits are permuted and the check digits made anew."""
        compact = F.replace(match, F.lit(" "), F.lit(""))
        country, account = F.substring(compact, 1, 2), F.substring(compact, F.lit(5), F.length(compact))
        found = _digits(account)
        changed = F.when(F.length(found) >= 2, _laid_out(account, self.digits(found, "iban"))).otherwise(account)
        check = F.lpad((98 - _mod97(F.concat(changed, country, F.lit("00")))).cast("string"), 2, "0")
        made = _laid_out(match, F.concat(check, _digits(changed)))
        return F.when(_mod97(F.concat(account, F.substring(compact, 1, 4))) == 1, made).otherwise(match)

    def email(self, match: Column) -> Column:
        """No number, so no permutation: a keyed digest of the address, case aside, at a reserved domain."""
        return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(self.key), F.lit("email"), F.lower(match)), 256), 1, 16), F.lit("@example.invalid"))

    def any(self, match: Column) -> Column:
        is_like = lambda form: match.rlike(f"^(?:{form})$")
        return (
            F.when(match.contains("@"), self.email(match))
            .when(is_like(IBAN), self.iban(match))
            .when(is_like(PHONE), self.phone(match))
            .when(is_like(IPV4), self.ipv4(match))
            .when(is_like(SSN), self.ssn(match))
            .when(match.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), self.date(match, "yyyy-MM-dd"))
            .when(match.rlike("^[0-9]{4}/[0-9]{2}/[0-9]{2}$"), self.date(match, "yyyy/MM/dd"))
            .when(match.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), self.date(match, "dd.MM.yyyy"))
            .when(match.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), self.slash_date(match))
            .otherwise(self.card(match))
        )


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))


def _laid_out(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced in order."""

    def put(character: Column, at: Column) -> Column:
        number = F.length(_digits(F.substring(form, F.lit(1), at + 1)))
        return F.when(character.between("0", "9"), F.substring(digits, number, F.lit(1))).otherwise(character)

    return F.array_join(F.transform(_characters(form), put), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum; a multiple of ten if the number is valid."""

    def add(total: Column, pair: Column) -> Column:
        doubled = pair.d * 2
        return total + F.when(pair.i % 2 == 0, pair.d).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    places = F.transform(F.reverse(_characters(digits)), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(places, F.lit(0), add)


def _mod97(text: Column) -> Column:
    """The number behind digits and letters (A = 10) modulo 97."""

    def add(rest: Column, character: Column) -> Column:
        digit = character.between("0", "9")
        value = F.when(digit, F.ascii(character) - 48).otherwise(F.ascii(character) - 55)
        return (rest * F.when(digit, 10).otherwise(100) + value) % 97

    return F.aggregate(_characters(text), F.lit(0), add)


def _replaced(text: Column, matches: Column, pseudonym: Callable[[Column], Column]) -> Column:
    between = F.split(text, ANY, -1)
    filled = F.concat(F.transform(matches, pseudonym), F.array(F.lit("")))
    return F.array_join(F.flatten(F.zip_with(between, filled, lambda a, b: F.array(a, b))), "")


def pseudonymized(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """``docs`` with every valid personal number, date and mail address in ``text_column`` replaced.

    Card numbers (Luhn), IBANs (mod 97), phone numbers, IPv4 addresses, social security numbers and
    dates keep their format and stay valid; the same value becomes the same pseudonym everywhere,
    and different values of a format become different ones. (Written ``99/99/9999``, a first number
    over 12 is a day, else a month.) What fails its validation stays. Addresses get a digest. Texts are read whole; null and empty ones, and those without a
    match, stay as they are. Other columns are not touched. Without the key the pseudonyms cannot
    be undone; keep it out of shared plans.
    """
    names = Pseudonyms(key)
    text = F.col(f"{ROW}.`{text_column}`")
    # the matches are found once; a text without any is passed on as it is
    matched = carried(docs).withColumn("found", F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    changed = F.when(F.size("found") > 0, _replaced(text, F.col("found"), names.any)).otherwise(text)
    return matched.select(*[changed.alias(c) if c == text_column else F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns])
