"""Format-preserving pseudonyms of personal numbers, by DataFrame functions only.

E-mail addresses, IPv4 addresses, dates, phone, social security and bank account numbers
and payment cards are found by pattern and validated (octets, calendar, check digits).
Each valid one is a vector of small numbers, one per permuted place, on which a keyed
Feistel network of eight rounds works: half of the vector is shifted, place by place, by
a keyed hash of the other half.  This is a permutation of all values of the format, so
equal values have equal pseudonyms in all documents, however they are spelled, and
different ones stay different.  What the format fixes (separators, country codes, domain
names) stays, and check digits are made anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import named

ROUNDS = 8
# The patterns of each kind, tried in this order.
_LEFT, _RIGHT = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})",
    "ip": _LEFT + r"(?<!\.)\d{1,3}(?:\.\d{1,3}){3}" + _RIGHT + r"(?!\.\d)",
    "date": _LEFT + r"(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})" + _RIGHT,
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
             r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})" + _RIGHT,
    "ssn": _LEFT + r"\d{3}-\d{2}-\d{4}" + _RIGHT,
    "iban": _LEFT + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _RIGHT,
    "card": _LEFT + r"(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})" + _RIGHT,
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# The Gregorian calendar repeats after 400 years of 189 * 773 days.  Dates of 1800 to 2199 are permuted
# among themselves, and so are all others of the years 0000 to 9999, which are 24 times as many.
_CYCLE, _DAYS, _OTHER_CYCLES = 400, (189, 773), 24
_FIRST_YEAR = 1800
_CYCLE_DAYS = _DAYS[0] * _DAYS[1]
_DAYS_BEFORE = date(_FIRST_YEAR, 1, 1).toordinal() + 365  # from 0000-01-01; the year 0 has 366 days


def _chars(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)))


def _digits(value: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(value, "[^0-9]", "")), lambda c: c.cast("int"))


def _luhn(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last being the check digit."""
    n = F.size(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.get(digits, n - 1 - i)
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _modulo_97(account: Column) -> Column:
    """Remainder of an account number, country and check digits moved to its end."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(_chars(turned), F.lit(0), add)


def _date_of(value: Column) -> Column:
    written = F.when(value.contains("-"), value).when(
        value.contains("."), F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 4, 2),
                                         F.substring(value, 1, 2))).otherwise(
        F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 1, 2), F.substring(value, 4, 2)))
    return written.try_cast("date")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("int") <= 255)
    if kind == "date":
        return _date_of(value).isNotNull()
    if kind == "phone":
        return F.size(_digits(value)).between(8, 15)
    if kind == "ssn":
        return ~value.rlike(r"^(000|666|9\d\d)|-00-|-0000$")
    if kind == "iban":
        return _modulo_97(value) == 1
    if kind == "card":
        return _luhn(_digits(value)) % 10 == 0
    return F.lit(True)


def _kind_of(value: Column) -> Column:
    """The first kind whose pattern the whole match fits and whose check it passes; else null."""
    chosen = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        fits = value.rlike(f"^(?:{pattern})$")
        chosen = F.when(fits & F.when(fits, _valid(kind, value)).otherwise(F.lit(False)), F.lit(kind)).otherwise(chosen)
    return chosen


def _place(value: int | Column, size: int | Column) -> Column:
    as_int = [x.cast("int") if isinstance(x, Column) else F.lit(x).cast("int") for x in (value, size)]
    return F.struct(as_int[0].alias("value"), as_int[1].alias("size"))


def _char_places(value: Column) -> Column:
    """One place per character; all but ASCII letters and digits stay."""
    def place(c: Column) -> Column:
        code = F.ascii(c)
        return F.when(c.rlike("[0-9]"), _place(code - 48, 10)).when(
            c.rlike("[a-z]"), _place(code - 97, 26)).when(c.rlike("[A-Z]"), _place(code - 65, 26)).otherwise(_place(0, 1))

    return F.transform(_chars(value), place)


def _compact(value: Column) -> Column:
    """A phone, account or card number without its separators."""
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def _head(kind: Column, value: Column) -> Column:
    """How many characters of the compact number stay: country codes, check digits, first digit of a card."""
    country = F.when(value.startswith("+1"), 1).when(value.startswith("+"), 2).otherwise(0)
    return F.when(kind == "phone", country).when(kind == "iban", 4).when(kind == "card", 1).otherwise(0)


def _body(kind: Column, value: Column) -> Column:
    """What is permuted of a phone, account or card number: no separator takes part, so spellings agree."""
    head = _head(kind, value)
    tail = F.when(kind == "card", 1).otherwise(0)
    return F.substring(_compact(value), head + 1, F.length(_compact(value)) - head - tail)


def _in_common_years(value: Column) -> Column:
    return F.year(_date_of(value)).between(_FIRST_YEAR, _FIRST_YEAR + _CYCLE - 1)


def _places(kind: Column, value: Column) -> Column:
    since = F.datediff(_date_of(value), F.lit(f"{_FIRST_YEAR}-01-01").cast("date"))
    common = _in_common_years(value)
    # Days of other years in turn, the common years left out.
    day = F.when(common, since).when(since < 0, since + _DAYS_BEFORE).otherwise(since + _DAYS_BEFORE - _CYCLE_DAYS)
    most = F.when(common, _DAYS[0]).otherwise(_DAYS[0] * _OTHER_CYCLES)
    area = F.substring(value, 1, 3).try_cast("int")
    local = F.substring_index(value, "@", 1)
    return (F.when(kind == "email", _char_places(local))
            .when(kind == "ip", F.transform(F.split(value, r"\."), lambda part: _place(part.try_cast("int"), 256)))
            .when(kind == "date", F.array(_place(F.floor(day / _DAYS[1]), most), _place(day % _DAYS[1], _DAYS[1])))
            .when(kind == "ssn", F.array(_place(F.when(area > 666, area - 2).otherwise(area - 1), 898),
                                         _place(F.substring(value, 5, 2).try_cast("int") - 1, 99),
                                         _place(F.substring(value, 8, 4).try_cast("int") - 1, 9999)))
            .otherwise(_char_places(_body(kind, value))))


def permuted(places: Column, key: str, tweak: Column) -> Column:
    """The Feistel network over an array of ``value, size`` structs; gives the new values."""
    half = F.floor(F.size(places) / 2).cast("int")
    rest = (F.size(places) - half).cast("int")

    def turn(state: Column, number: Column) -> Column:
        other = F.array_join(F.transform(state["right"], lambda place: place["value"].cast("string")), ",")

        def shift(place: Column, i: Column) -> Column:
            text = F.concat_ws("|", F.lit(key), tweak, number.cast("string"), i.cast("string"), other)
            amount = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")
            return F.struct(F.pmod(place["value"] + amount, place["size"].cast("bigint")).cast("int").alias("value"),
                            place["size"].alias("size"))

        return F.struct(state["right"].alias("left"), F.transform(state["left"], shift).alias("right"))

    # An even number of rounds brings both halves back to their places.
    begin = F.struct(F.slice(places, F.lit(1), half).alias("left"), F.slice(places, half + 1, rest).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, turn,
                       lambda state: F.transform(F.concat(state["left"], state["right"]), lambda place: place["value"]))


def _written(chars: Column, values: Column) -> Column:
    def char(c: Column, i: Column) -> Column:
        new = F.get(values, i)
        return F.when(c.rlike("[0-9]"), F.char(new + 48)).when(
            c.rlike("[a-z]"), F.char(new + 97)).when(c.rlike("[A-Z]"), F.char(new + 65)).otherwise(c)

    return F.array_join(F.transform(chars, char), "")


def _laid_out(value: Column, compact: Column) -> Column:
    """The compact number with the separators of ``value`` in their places."""
    def step(state: Column, c: Column) -> Column:
        own = c.rlike("[A-Za-z0-9]")
        return F.struct(
            F.when(own, F.substring(state["rest"], F.lit(2), F.length(state["rest"]))).otherwise(state["rest"]).alias("rest"),
            F.concat(state["done"], F.when(own, F.substring(state["rest"], 1, 1)).otherwise(c)).alias("done"))

    begin = F.struct(compact.alias("rest"), F.lit("").alias("done"))
    return F.aggregate(_chars(value), begin, step, lambda state: state["done"])


def _spelled(kind: Column, value: Column, new: Column) -> Column:
    """The pseudonym: new values in the format of the old."""
    day = F.get(new, F.lit(0)) * _DAYS[1] + F.get(new, F.lit(1))
    since = F.when(_in_common_years(value), day).when(day < _DAYS_BEFORE, day - _DAYS_BEFORE).otherwise(
        day - _DAYS_BEFORE + _CYCLE_DAYS)
    new_date = F.date_add(F.lit(f"{_FIRST_YEAR}-01-01").cast("date"), since)
    style = F.when(value.contains("-"), F.date_format(new_date, "yyyy-MM-dd")).when(
        value.contains("."), F.date_format(new_date, "dd.MM.yyyy")).otherwise(F.date_format(new_date, "MM/dd/yyyy"))
    area = F.get(new, F.lit(0)) + 1
    ssn = F.format_string("%03d-%02d-%04d", F.when(area >= 666, area + 1).otherwise(area),
                          F.get(new, F.lit(1)) + 1, F.get(new, F.lit(2)) + 1)
    kept = F.substring(_compact(value), F.lit(1), _head(kind, value))
    body = _written(_chars(_body(kind, value)), new)
    check = F.pmod(10 - _luhn(_digits(F.concat(kept, body, F.lit("0")))) % 10, F.lit(10)).cast("string")
    land = F.substring(kept, 1, 2)
    rest = F.lpad((98 - _modulo_97(F.concat(land, F.lit("00"), body))).cast("string"), 2, "0")
    local = F.substring_index(value, "@", 1)
    return (F.when(kind == "email", F.concat(_written(_chars(local), new),
                                             F.substring(value, F.length(local) + 1, F.length(value))))
            .when(kind == "ip", F.array_join(F.transform(new, lambda part: part.cast("string")), "."))
            .when(kind == "date", style).when(kind == "ssn", ssn)
            .otherwise(_laid_out(value, F.when(kind == "card", F.concat(kept, body, check))
                                 .when(kind == "iban", F.concat(land, rest, body)).otherwise(F.concat(kept, body)))))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal values in ``text_col`` replaced, plus ``_pii``.

    ``_pii`` is an array of ``kind, pseudonym`` in order of the text, empty where nothing
    was found; it takes the place of a column of that name.  A null text stays null, a text without valid values is unchanged, character
    by character.  Dates may be of any year with four digits; phone, account and card numbers are
    linked whatever their separators.  Of patterns that overlap the first to begin counts, then the
    first in order of ``PATTERNS``.  Numbers that fail their check (a card number with a wrong check digit, an
    octet above 255) are left alone.  All rows, repeated ones too, and other columns stay; an empty
    table gives an empty one.  A text is held whole with its values, however long.
    """
    text = named(text_col)
    may_hold = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    none = F.array().cast("array<string>")
    cut = docs.withColumn("_pi_found", F.when(may_hold, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none))
    kinds = cut.withColumn("_pi_kinds", F.transform("_pi_found", _kind_of))
    some = F.exists("_pi_kinds", lambda kind: kind.isNotNull())
    vectors = kinds.withColumn("_pi_places", F.when(some, F.zip_with("_pi_kinds", "_pi_found", _places)))
    tweaked = vectors.withColumn("_pi_new", F.zip_with("_pi_kinds", "_pi_places", lambda kind, places: F.when(
        kind.isNotNull(), permuted(places, key, kind))))
    spelled = tweaked.withColumn("_pi_spelled", F.transform(
        F.arrays_zip("_pi_kinds", "_pi_found", "_pi_new"),
        lambda x: F.when(x["_pi_kinds"].isNull(), x["_pi_found"]).otherwise(
            _spelled(x["_pi_kinds"], x["_pi_found"], x["_pi_new"]))))
    joined = F.array_join(F.transform(
        F.arrays_zip(F.split(text, ANY).alias("gap"), F.col("_pi_spelled").alias("new")),
        lambda x: F.concat(F.coalesce(x["gap"], F.lit("")), F.coalesce(x["new"], F.lit("")))), "")
    pii = F.filter(F.zip_with("_pi_kinds", "_pi_spelled", lambda kind, new: F.struct(
        kind.alias("kind"), new.alias("pseudonym"))), lambda x: x["kind"].isNotNull())
    done = spelled.withColumns({text_col: F.when(some, joined).otherwise(text), "_pii": F.coalesce(
        pii, F.array().cast("array<struct<kind:string,pseudonym:string>>"))})
    return done.drop("_pi_found", "_pi_kinds", "_pi_places", "_pi_new", "_pi_spelled")
