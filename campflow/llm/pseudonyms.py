"""Format-preserving pseudonyms for personal numbers and dates.

Values are found by shape, validated, and permuted by a keyed Feistel network within their own format: a card number
becomes another one of its length that passes the Luhn check, a date another date. A network of ``ROUNDS`` rounds over
two halves adds to one half, modulo its size, a keyed hash of the other; that is a permutation, so different values
stay different and equal values equal in all documents. Values that fail validation are ordinary text and stay.

Mail addresses and hexadecimal secrets have no numeric format; a keyed hash of their own length takes their place.

Everything is DataFrame functions: no Python runs on the executors. The key is part of the query plan: give it to jobs
whose plans only those may see who may know the key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_WORDISH = r"\p{L}\p{N}._%+\-"

#: Fixed: the length of account numbers by country, where they may be printed in groups of four.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_GROUPED = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in _IBAN_COUNTRIES.items()
)
_BETWEEN = r"[ .\-/()]{0,2}"

#: Shapes, tried in this order at each place of a text.
SHAPES: dict[str, str] = {
    "mail": rf"(?<![{_WORDISH}])[{_WORDISH}]++@[\p{{L}}\p{{N}}\-]+(?:\.[\p{{L}}\p{{N}}\-]+)*\.\p{{L}}{{2,}}",
    "hex": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|" + _IBAN_GROUPED + r")(?![0-9A-Za-z])",
    "phone": rf"(?<![0-9+])\+1(?:{_BETWEEN}[0-9]){{10}}(?![0-9])"
             rf"|(?<![0-9+])\+[0-9](?:{_BETWEEN}[0-9]){{7,14}}(?![0-9]|[./\-][0-9])"
             r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
             r"|(?<![0-9.\-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9\-])"
             r"|(?<![0-9.\-])[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "address": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "date": r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
            r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])",
    "person": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}"
            r"|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])",
}
_ANY = "|".join(SHAPES.values())

#: Dates from 1800-01-01 on for one cycle of the calendar, 400 years: 189 * 773 days.
_FIRST_DAY, _DAY_HIGH, _DAY_LOW = "1800-01-01", 189, 773


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _whole(shape: str, value: Column) -> Column:
    return value.rlike(f"^(?:{SHAPES[shape]})$")


def _permuted(left: Column, right: Column, left_size: Column, right_size: Column, tweak: Column, key: str) -> Column:
    """Struct ``l, r``: the pair (left, right) permuted within [0, left_size) x [0, right_size)."""

    def hashed(nth: Column, half: Column) -> Column:
        seen = F.concat_ws(":", F.lit(key), tweak, nth.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(seen, 256), 1, 15), 16, 10).cast("long")

    def turn(state: Column, nth: Column) -> Column:
        a, b = state["l"], state["r"]
        even = F.struct(((a + hashed(nth, b) % left_size) % left_size).alias("l"), b.alias("r"))
        odd = F.struct(a.alias("l"), ((b + hashed(nth, a) % right_size) % right_size).alias("r"))
        return F.when(nth % 2 == 0, even).otherwise(odd)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """A string of up to 36 digits permuted among those of its length."""

    def size(k: Column) -> Column:
        return F.concat(F.lit("1"), F.repeat(F.lit("0"), k)).cast("long")

    def permute(d: Column) -> Column:
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        left, right = F.concat(F.lit("0"), F.substring(d, F.lit(1), half)), F.substring(d, half + 1, n)
        tweak = F.concat(F.lit(f"{kind}:"), n)

        def text(out: Column) -> Column:
            first = F.when(half > 0, F.lpad(out["l"].cast("string"), half, "0")).otherwise("")
            return F.concat(first, F.lpad(out["r"].cast("string"), n - half, "0"))

        return _let(_permuted(left, right, size(half), size(n - half), tweak, key), text)

    return _let(digits, permute)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order."""
    steps = F.regexp_extract_all(value, F.lit("[^0-9]*[0-9]"), F.lit(0))
    tail = F.regexp_extract(value, "[^0-9]*$", 0)

    def put(new: Column) -> Column:
        each = F.transform(steps, lambda s, i: F.concat(F.substring(s, F.lit(1), F.length(s) - 1), F.substring(new, i + 1, F.lit(1))))
        return F.concat(F.array_join(each, ""), tail)

    return _let(digits, put)


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """The Luhn sum of ``digits``; the last digit is doubled if ``doubled_from_right`` is 0, the one before if 1."""

    def total(text: Column) -> Column:
        def add(so_far: Column, place: Column) -> Column:
            d = F.substring(text, F.length(text) - place, F.lit(1)).cast("int")
            doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return so_far + F.when(place % 2 == doubled_from_right, doubled).otherwise(d)

        return F.aggregate(F.sequence(F.lit(0), F.length(text) - 1), F.lit(0), add)

    return _let(digits, total)


def _card(value: Column, key: str) -> Column:
    def renewed(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), "card", key)
        checked = _let(body, lambda b: F.concat(b, ((F.lit(10) - _luhn_sum(b, 0) % 10) % 10).cast("string")))
        return F.when(_luhn_sum(digits, 1) % 10 == 0, _refilled(value, checked))

    return _let(_digits(value), renewed)


def _mod97(value: Column) -> Column:
    """An account number's remainder: its first four characters moved to the end, letters read as 10 to 35."""

    def rest(moved: Column) -> Column:
        def add(so_far: Column, place: Column) -> Column:
            code = F.ascii(F.substring(moved, place, F.lit(1)))
            return F.when(code < 58, (so_far * 10 + code - 48) % 97).otherwise((so_far * 100 + code - 55) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)

    return _let(F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4)), rest)


def _iban(value: Column, key: str) -> Column:
    account, country = F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 2)
    digits = _digits(account)
    renewed = F.when(F.length(digits) > 0, _refilled(account, permuted_digits(digits, "iban", key))).otherwise(account)

    def whole(new: Column) -> Column:
        check = F.lit(98) - _mod97(F.concat(country, F.lit("00"), F.replace(new, F.lit(" "), F.lit(""))))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), new)

    return F.when(_mod97(F.replace(value, F.lit(" "), F.lit(""))) == 1, _let(renewed, whole))


def _phone(value: Column, key: str) -> Column:
    # the country code stays: the digits after a plus and before a separator
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .\-/(])", 0)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    return F.concat(country, _refilled(rest, permuted_digits(_digits(rest), "phone", key)))


def _address(value: Column, key: str) -> Column:
    def renewed(parts: Column) -> Column:
        high, low, half = parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536)
        octets = lambda o: F.concat_ws(
            ".", *(x.cast("string") for h in "lr" for x in (F.floor(o[h] / 256), o[h] % 256))
        )
        new = _let(_permuted(high, low, half, half, F.lit("address"), key), octets)
        return F.when(F.forall(parts, lambda p: p < 256), new)

    return _let(F.transform(F.split(value, r"\."), lambda p: p.cast("long")), renewed)


def _date(value: Column, key: str) -> Column:
    # year first, or month before day with slashes, or day before month with dots
    year_first, slashes, plain = value.rlike("^[0-9]{4}-"), value.contains("/"), F.length(value) < 10
    first = F.lit(_FIRST_DAY).cast("date")

    def number(split: Column) -> Column:
        year = F.when(year_first, split[0]).otherwise(split[2])
        month = F.when(year_first | ~slashes, split[1]).otherwise(split[0])
        day = F.when(year_first, split[2]).when(slashes, split[1]).otherwise(split[0])
        iso = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.datediff(F.to_date(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))), first)

    def shown(new: Column) -> Column:
        return (
            F.when(year_first, F.date_format(new, "yyyy-MM-dd"))
            .when(slashes & plain, F.date_format(new, "M/d/yyyy")).when(slashes, F.date_format(new, "MM/dd/yyyy"))
            .when(plain, F.date_format(new, "d.M.yyyy")).otherwise(F.date_format(new, "dd.MM.yyyy"))
        )

    def renewed(days: Column) -> Column:
        high, low = F.lit(_DAY_HIGH), F.lit(_DAY_LOW)
        new = _permuted(F.floor(days / _DAY_LOW), days % _DAY_LOW, high, low, F.lit("date"), key)
        moved = _let(new, lambda o: F.date_add(first, (o["l"] * _DAY_LOW + o["r"]).cast("int")))
        return F.when(days.between(0, _DAY_HIGH * _DAY_LOW - 1), _let(moved, shown))

    return _let(_let(F.split(value, r"[./\-]"), number), renewed)


def _person(value: Column, key: str) -> Column:
    # no number has an all-zero group, area 666 or an area from 900 on
    valid = ~value.rlike("^(?:000|666|9)") & ~value.rlike("-00-") & ~value.rlike("-0000$")
    return F.when(valid, _refilled(value, permuted_digits(_digits(value), "person", key)))


def _keyed(value: Column, key: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lower(value)), 512)


def _mail(value: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(_keyed(value, key), 1, 16), F.lit("@example.invalid"))


def _hex(value: Column, key: str) -> Column:
    out = F.substring(_keyed(value, key), F.lit(1), F.length(value))
    return F.when(value == F.upper(value), F.upper(out)).otherwise(out)


_KINDS: dict[str, Callable[[Column, str], Column]] = {
    "mail": _mail, "hex": _hex, "iban": _iban, "phone": _phone, "address": _address, "date": _date, "person": _person,
    "card": _card,
}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value; null if it is not valid in its format."""
    out = None
    for kind, make in _KINDS.items():
        fits = _whole(kind, value)
        out = F.when(fits, make(value, key)) if out is None else out.when(fits, make(value, key))
    return out


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and ``n_values``, the number of values that were replaced.

    Null and empty texts stay, with 0. Rows are treated one by one, so repeated rows and ids do not matter. Extra
    columns are carried; one named ``n_values`` is replaced.
    """
    text = F.col("text")
    found = F.transform(F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), lambda v: F.struct(v.alias("was"), pseudonym(v, key).alias("new")))
    seen = docs.withColumn("n_values", F.when(text.rlike("[0-9@]"), found))
    values = F.col("n_values")
    between = F.split(text, _ANY, -1)
    joined = F.concat(
        F.element_at(between, 1),
        F.array_join(F.zip_with(values, F.slice(between, F.lit(2), F.size(values)), lambda v, after: F.concat(F.coalesce(v["new"], v["was"]), after)), ""),
    )
    changed = F.size(F.filter(values, lambda v: v["new"].isNotNull()))
    return seen.withColumns({
        "text": F.when(F.size(values) > 0, joined).otherwise(text),
        "n_values": F.when(values.isNull(), 0).otherwise(changed).cast("long"),
    })
