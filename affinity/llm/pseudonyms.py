"""Personal data: keyed, format-preserving Feistel pseudonyms.

A value is found by its shape, validated, and replaced by another valid value of the same shape:
its free places are the digits of a mixed-radix number, which an alternating Feistel network
permutes; the round function is SHA-512 of key, kind, round and the other half. A permutation is
one to one, so equal values get equal pseudonyms in all documents, different values different
ones, and the holder of the key can go back. Checksums are computed anew.

| kind | validated by | permuted |
| --- | --- | --- |
| email | shape | letters and digits of the name, each within its class |
| iban | length (the country's, if in groups of four), remainder modulo 97 | digits and letters after the check digits |
| ipv4 | four numbers up to 255 | the four numbers |
| date | the calendar, within ``FIRST_DAY`` and ``DATE_SIDE**2`` days | the day's number |
| ssn | no zero group, first group not 666 or above 899 | the three groups |
| phone | ten digits with first and fourth from 2 to 9, or ``+`` and 8 to 15 digits | all but the country's digits |
| card | 13 to 19 digits, Luhn | all but the first digit and the check digit |
| key | an access key id, a hexadecimal token of 32 to 64, a password's assigned value | letters and digits |

All of it is column expressions on the row's own text; nothing is shuffled. Texts without a
find are passed on unread a second time. Defined cases: a null text stays null, an empty one
empty, with no replacements; what is not valid is left as it is; repeated rows are treated alike;
all columns of the input are kept, and the names the work needs do not clash with them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.stage import free_name

ROUNDS = 8
DEFAULT_KEY = "change this key"
FIRST_DAY = "1900-01-01"
DATE_SIDE = 270

#: Countries by the length of their IBANs, to tell where one in groups of four ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC"}


def _grouped_ibans() -> str:
    """IBANs in groups of four, the last one of what is left, with one separator throughout."""
    return "|".join(
        f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:{gap}[A-Z0-9]{{4}}){{{n // 4 - 1}}}"
        + (f"{gap}[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, countries in IBAN_LENGTHS.items() for gap in " -")


#: Shapes by kind; at one place the first kind that fits wins.
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{32,64}+)(?![A-Za-z0-9])"
           r"|(?<![A-Za-z])password=[A-Za-z0-9]{6,}",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_grouped_ibans()})(?![A-Za-z0-9])",
    "ipv4": r"(?<![0-9A-Za-z.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
            r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])"
            r"|(?<![0-9A-Za-z./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?=[Tt][0-9]{2})",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
             r"|\+[0-9](?:[ .-]?\(?[0-9]{1,4}\)?){2,6})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"
            r"|[0-9]{4} [0-9]{6} [0-9]{4,5}|[0-9]{4}-[0-9]{6}-[0-9]{4,5}|[0-9]{13,19}+)(?![0-9A-Za-z])",
}
ANY_SHAPE = "|".join(f"(?:{shape})" for shape in SHAPES.values())
#: Of a text without any of these there is nothing to find: keys alone need neither a digit nor an @.
HINT = r"[0-9@]|AKIA|password=|[a-f]{32}"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def feistel(values: Column, radices: Column, kind: str, key: str) -> Column:
    """Permute mixed-radix numbers: ``values`` with value i below radix i, both array<int>.

    Even and odd places take turns: each place of one half moves by a number that the key and
    the other half give, modulo its radix.
    """
    def one_round(state: Column, turn: Column) -> Column:
        other = F.filter(state, lambda x, i: i % 2 != turn % 2)
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"),
                                    F.size(state).cast("string"),
                                    F.array_join(other.cast("array<string>"), ",")), 512)

        def moved(d: Column, x: Column, i: Column) -> Column:
            word = F.substr(d, F.lit(1) + F.lit(8) * (F.floor(i / 2).cast("int") % 16), F.lit(8))
            return ((x + F.conv(word, 16, 10).cast("long")) % F.get(radices, i)).cast("int")

        return bound(digest, lambda d: F.transform(
            state, lambda x, i: F.when(i % 2 == turn % 2, moved(d, x, i)).otherwise(x)))

    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), values.cast("array<int>"), one_round)


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _from(value: Column, start: int) -> Column:
    return F.substr(value, F.lit(start))


def _part(value: Column, start: int, length: int) -> Column:
    return F.substr(value, F.lit(start), F.lit(length))


def _numbers(digits: Column) -> Column:
    return _characters(digits).cast("array<int>")


def _joined(numbers: Column) -> Column:
    return F.array_join(numbers.cast("array<string>"), "")


def _relaid(shape: Column, new: Column, places: str = "0-9") -> Column:
    """``shape`` with its digits, or other ``places``, replaced, one by one, by ``new``."""
    def at(i: Column) -> Column:
        return F.lit(1) + F.length(F.regexp_replace(F.substr(shape, F.lit(1), i), f"[^{places}]", ""))

    return F.array_join(F.transform(_characters(shape), lambda c, i: F.when(
        c.rlike(f"[{places}]"), F.substr(new, at(i), F.lit(1))).otherwise(c)), "")


def _permuted_characters(value: Column, kind: str, key: str, letters: int = 26) -> Column:
    """Digits move among digits, small letters among ``letters`` small ones, capitals among capitals."""
    def base(c: Column) -> Column:
        return (F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65)
                .otherwise(F.ascii(c)))

    def radix(c: Column) -> Column:
        return (F.when(c.rlike("[0-9]"), 10).when(c.rlike("[a-z]"), letters).when(c.rlike("[A-Z]"), 26)
                .otherwise(1))

    def permuted(chars: Column) -> Column:
        moved = feistel(F.transform(chars, lambda c: F.ascii(c) - base(c)), F.transform(chars, radix), kind, key)
        return F.array_join(F.zip_with(chars, moved, lambda c, n: F.chr((base(c) + n).cast("long"))), "")

    return bound(_characters(value), permuted)


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(_permuted_characters(name, "email", key), F.substr(m, F.length(name) + 1))


def _key(m: Column, key: str) -> Column:
    return (F.when(m.rlike("^AKIA[A-Z0-9]{16}$"),
                   F.concat(F.lit("AKIA"), _permuted_characters(_from(m, 5), "key", key)))
            .when(m.rlike("^[0-9a-f]{32,64}$"), _permuted_characters(m, "token", key, 6))
            .otherwise(F.concat(F.lit("password="), _permuted_characters(_from(m, 10), "key", key))))


def _mod97(value: Column) -> Column:
    return F.aggregate(_characters(value), F.lit(0), lambda acc, c: F.when(
        c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _iban(m: Column, key: str) -> Column:
    def of(plain: Column) -> Column:
        country = _part(plain, 1, 2)
        new = bound(_permuted_characters(_from(plain, 5), "iban", key), lambda rest: F.concat(
            country, F.lpad((98 - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0"), rest))
        # What is no IBAN may have hidden a card in groups of four.
        card = F.when(m.rlike("^.{4}([ -])[0-9]{4}(?:\\1[0-9]{4}){3}"),
                      F.concat(_part(m, 1, 5), _card(_part(m, 6, 19), key), _from(m, 25))).otherwise(m)
        return (F.when(_mod97(F.concat(_from(plain, 5), _part(plain, 1, 4))) != 1, card)
                .otherwise(_relaid(m, new, "A-Z0-9")))

    return bound(F.regexp_replace(m, "[ -]", ""), of)


def _ipv4(m: Column, key: str) -> Column:
    numbers = F.split(m, r"\.").cast("array<int>")
    new = F.array_join(feistel(numbers, F.array(*[F.lit(256)] * 4), "ipv4", key).cast("array<string>"), ".")
    return F.when(F.forall(numbers, lambda n: n <= 255), new).otherwise(m)


def _date(m: Column, key: str) -> Column:
    iso, dotted = m.rlike("^[0-9]{4}-"), m.contains(".")
    first, second = _part(m, 1, 2).cast("int"), _part(m, 4, 2).cast("int")
    # Day first, but for a slashed date whose second number can only be a day.
    month_first = m.contains("/") & (second > 12)
    year = F.when(iso, _part(m, 1, 4)).otherwise(_part(m, 7, 4)).cast("int")
    month = F.when(iso, _part(m, 6, 2).cast("int")).otherwise(F.when(month_first, first).otherwise(second))
    day = F.when(iso, _part(m, 9, 2).cast("int")).otherwise(F.when(month_first, second).otherwise(first))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    valid = (year >= 1900) & (year <= 2099) & month.between(1, 12) & (day >= 1) & (day <= last)
    start = F.lit(FIRST_DAY).cast("date")
    number = F.when(valid, F.datediff(F.make_date(year, month, day), start)).otherwise(-1)

    def moved(n: Column) -> Column:
        places = F.array((n / DATE_SIDE).cast("int"), n % DATE_SIDE)
        new = feistel(places, F.array(F.lit(DATE_SIDE), F.lit(DATE_SIDE)), "date", key)
        return bound(new, lambda p: F.date_add(start, p[0] * DATE_SIDE + p[1]))

    def shown(d: Column) -> Column:
        return (F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(dotted, F.date_format(d, "dd.MM.yyyy"))
                .when(month_first, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy")))

    return F.when((number >= 0) & (number < DATE_SIDE ** 2),
                  bound(moved(number), shown)).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    places = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)

    def shown(p: Column) -> Column:
        return F.concat_ws("-", F.lpad(F.when(p[0] >= 665, p[0] + 2).otherwise(p[0] + 1).cast("string"), 3, "0"),
                           F.lpad((p[1] + 1).cast("string"), 2, "0"), F.lpad((p[2] + 1).cast("string"), 4, "0"))

    return F.when(valid, bound(feistel(places, F.array(F.lit(898), F.lit(99), F.lit(9999)), "ssn", key),
                               shown)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        lead = F.when(F.length(digits) == 11, _part(digits, 1, 1)).otherwise(F.lit(""))
        ten = F.when(F.length(digits) == 11, _from(digits, 2)).otherwise(digits)
        national = ten.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$") & lead.isin("", "1")
        offsets = F.array(*[F.lit(2 * (i in (0, 3))) for i in range(10)])
        radices = F.array(*[F.lit(10 - 2 * (i in (0, 3))) for i in range(10)])
        moved = feistel(F.zip_with(_numbers(ten), offsets, lambda x, o: x - o), radices, "phone", key)
        new = F.concat(lead, _joined(F.zip_with(moved, offsets, lambda x, o: x + o)))
        rest = _numbers(_from(digits, 3))
        other = F.concat(_part(digits, 1, 2), _joined(
            feistel(rest, F.transform(rest, lambda x: F.lit(10)), "phone", key)))
        return (F.when(national, _relaid(m, new))
                .when(m.startswith("+") & F.length(digits).between(8, 15), _relaid(m, other)).otherwise(m))

    return bound(_digits(m), of)


def _luhn(numbers: Column) -> Column:
    """The Luhn sum of digits whose last one is the check digit."""
    def term(x: Column, i: Column) -> Column:
        twice = x * (F.lit(1) + i % 2)
        return twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.reverse(numbers), term), F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: str) -> Column:
    def of(n: Column) -> Column:
        middle = F.slice(n, F.lit(2), F.size(n) - 2)
        moved = feistel(middle, F.transform(middle, lambda x: F.lit(10)), "card", key)
        body = F.concat(F.slice(n, 1, 1), moved)
        new = bound(body, lambda b: F.concat(b, F.array(
            (10 - _luhn(F.concat(b, F.array(F.lit(0)))) % 10) % 10)))
        return F.when(_luhn(n) % 10 == 0, _relaid(m, _joined(new))).otherwise(m)

    return bound(_numbers(_digits(m)), of)


_BY_KIND = {"email": _email, "key": _key, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn,
            "phone": _phone, "card": _card}
#: The shapes without what must stand around them, to tell the kind of a find.
_ALONE = {kind: re.sub(r"\(\?<?[!=][^()]*\)", "", shape) for kind, shape in SHAPES.items()}


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one find; the find itself if it is not valid."""
    out = found
    for kind in reversed(SHAPES):
        fits = found.rlike(f"^(?:{_ALONE[kind]})$")
        out = F.when(fits, _BY_KIND[kind](found, key)).otherwise(out)
    return out


def pseudonymise(documents: DataFrame, key: str = DEFAULT_KEY, count: str = "n_pseudonyms",
                 chars: str | None = None) -> DataFrame:
    """All columns of ``documents`` with ``text`` pseudonymised, and the number of replacements.

    The number is in the column ``count``, or in the first numbered one of that name that is free.
    A column ``chars``, if it is named, gets the new texts' numbers of code points.
    """
    work, count = free_name("finds", [*documents.columns, count]), free_name(count, documents.columns)
    text = F.col("text")
    none = F.array().cast("array<struct<old:string,new:string>>")
    finds = F.when(text.rlike(HINT), F.transform(
        F.regexp_extract_all(text, F.lit(f"({ANY_SHAPE})"), F.lit(0)),
        lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))).otherwise(none)
    found = documents.withColumn(work, F.coalesce(finds, none))
    # Explode-free rebuild: what stands between the finds, and the finds' pseudonyms, in turn.
    between = F.split(text, ANY_SHAPE, -1)
    new = F.col(f"{work}.new")
    rebuilt = F.array_join(F.flatten(F.zip_with(
        between, new, lambda gap, name: F.array(gap, F.coalesce(name, F.lit(""))))), "")
    kept = [F.when(F.size(work) > 0, rebuilt).otherwise(text).alias("text") if name == "text"
            else F.col(f"`{name}`") for name in documents.columns]
    changed = F.size(F.filter(work, lambda f: f["old"] != f["new"])).cast("long")
    out = found.select(*kept, changed.alias(count))
    return out if chars is None else out.withColumn(chars, F.char_length("text").cast("long"))
