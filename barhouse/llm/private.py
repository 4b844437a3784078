"""Pseudonyms for personal data that keep its format, in DataFrame operations only.

Numbers and dates that pass validation (check digits, ranges, the calendar) are permuted by a
keyed Feistel network inside the set of valid values of their format, so a pseudonym is valid
too, equal values get equal pseudonyms in every document, different ones different pseudonyms, and
the key's holder can undo it. Mail addresses and secret tokens have no such set; they get a keyed digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

# English names of months, and how secret keys of common services begin.
MONTHS = "January February March April May June July August September October November December".split()
KEY_STARTS = r"(?:AKIA|ASIA)(?=[0-9A-Z]{16}(?![0-9A-Za-z]))|gh[opsur]_(?=[0-9A-Za-z]{36}(?![0-9A-Za-z]))"

# How long the IBANs of a country are.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_forms() -> str:
    """Accounts of the length of their country, so words that follow aren't taken in; then those of any length."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        last = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{'|'.join(countries.split())})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{last}(?![0-9A-Za-z])")
    forms.append(r"[A-Z]{2}\d{2}(?: ?\d{4}){2,6}(?: ?\d{1,3})?(?![0-9A-Za-z])")
    forms.append(r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})"


# Dialling codes, those of three digits last.
_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\\d{2}"
_PLUS = (
    r"1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"  # +1 (212) 555-0123
    r"|[2-9]\d{6,14}"  # +442079460958
    r"|(?=(?:[ .()-]{0,2}\d){7,15}(?!\d))[2-9]\d{0,2}(?:[ .-]?\(\d{1,5}\)[ .-]?\d{1,8}(?:[ .-]\d{1,8}){0,4}|(?:[ .-]\d{1,8}){2,5}|[ .-]\d{5,12})"  # +33 1 23 45 67 89, +44 (0)20 7946 0958
    r"|[2-9]\d{0,2}(?:[ .-]\d{2,8}){2,4}"
)
_AMERICAN = r"(?<![\d+.-])(?:1[ .-])?(?:\([2-9]\d{2}\)[ .-]?[2-9]\d{2}[ .-]|[2-9]\d{2}-[2-9]\d{2}-|[2-9]\d{2}\.[2-9]\d{2}\.|[2-9]\d{2} [2-9]\d{2}[ -])\d{4}(?!\d|[.-]\d)"
# With the trunk prefix 0 and nine to twelve digits: 020 7946 0958, (030) 1234567, 01 23 45 67 89.
_TRUNK = (
    r"(?<![\d+.,/-])(?:0[1-9]\d{8}(?![\d]|[.,/-]\d)"
    r"|(?=(?:[ ()./-]{0,2}\d){9,12}(?![ ./-]?\d))(?:\(0[1-9]\d{0,3}\) ?\d{2,8}|0[1-9]\d{0,3}[ ./-]\d{2,8})(?:[ ./-]\d{2,8}){0,4}(?!\d))"
)
# Dialled with 00 for the plus, code apart: 00 44 20 7946 0958, 0044 20 7946 0958.
_DIALLED = rf"(?<![\d+.,/-])00 ?(?=[2-9]\d{{0,2}}[ .-]|1 )(?:{_PLUS})(?!\d)"
_NAMED = "|".join(MONTHS)

# What is looked at, leftmost first and in this order; whether it is private is decided by validation.
PATTERNS = {
    "mail": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "token": r"(?<=(?:token|key|secret|password)[ ]{0,2}[=:][ ]{0,2}\"{0,1})[0-9A-Fa-f]{32,}(?![0-9A-Za-z])",
    "service": rf"(?<![0-9A-Za-z_])(?:(?:{KEY_STARTS})[0-9A-Za-z]{{16,36}})",
    "iban": _iban_forms(),
    "phone": rf"(?<![\d+])\+(?:{_PLUS})(?!\d)",
    "address": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "social": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<!\d|\d[ .,-])\d{3} \d{2} \d{4}(?!\d|[ .,-]\d)",
    "date": r"(?<!\d)(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[./]\d{1,2}[./]\d{4})(?!\d)",
    "named": rf"(?<![\d.,])(?:\d{{1,2}} (?:{_NAMED}) \d{{4}}(?!\d)|(?<![\p{{L}}])(?:{_NAMED}) \d{{1,2}}, \d{{4}}(?!\d))",
    "dialled": _DIALLED,
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}(?: \d{6} |-\d{6}-)\d{5})(?!\d)",
    "american": _AMERICAN,
    "trunk": _TRUNK,
}
PATTERN = "|".join(PATTERNS.values())
# Any match holds a digit or an at sign.
_MAYBE = r"[0-9@]"

# 400 years are 189 * 773 days.
_FIRST_DAY, _DAYS = "1700-01-01", (189, 773)
_AREAS = 898 * 99
# Letters permuted together; 26 to the 13th is the highest power that fits a bigint.
_LETTERS = 26


def _long(c: Column) -> Column:
    return c.cast("bigint")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(a: Column, b: Column, size_a: Column | int, size_b: Column | int, key: str, tweak: str, undo: bool = False) -> Column:
    """Permute the pairs (a, b) of 0..size_a-1 and 0..size_b-1: each round adds a keyed hash of one half to the other."""
    size_a, size_b = (_long(F.lit(s)) if isinstance(s, int) else s for s in (size_a, size_b))
    rounds = F.array(*(F.lit(r) for r in (reversed(range(ROUNDS)) if undo else range(ROUNDS))))

    def add(to: Column, other: Column, r: Column, size: Column) -> Column:
        hashed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), r.cast("string"), other.cast("string")), 256)
        amount = _long(F.conv(F.substring(hashed, 1, 15), 16, 10))
        return F.pmod(to - amount if undo else to + amount, size)

    def step(s: Column, r: Column) -> Column:
        left = F.when(r % 2 == 0, add(s["a"], s["b"], r, size_a)).otherwise(s["a"])
        right = F.when(r % 2 == 1, add(s["b"], s["a"], r, size_b)).otherwise(s["b"])
        return F.struct(left.alias("a"), right.alias("b"))

    return F.aggregate(rounds, F.struct(_long(a).alias("a"), _long(b).alias("b")), step)


def _ten_to(n: Column) -> Column:
    return _long(F.rpad(F.lit("1"), n + 1, F.lit("0")))


def _digits(text: Column, key: str, tweak: str, undo: bool) -> Column:
    """Permute digit strings of one length, of 2 to 30 digits, among themselves."""

    def permuted(t: Column) -> Column:
        n = F.length(t)
        half = F.floor(n / 2).cast("int")
        a, b = F.substring(t, F.lit(1), half), F.substring(t, half + 1, n - half)
        sizes = F.struct(_ten_to(half).alias("a"), _ten_to(n - half).alias("b"))
        out = _let(sizes, lambda s: feistel(a, b, s["a"], s["b"], key, tweak, undo))
        return _let(out, lambda o: F.concat(F.lpad(o["a"].cast("string"), half, F.lit("0")), F.lpad(o["b"].cast("string"), n - half, F.lit("0"))))

    return _let(text, permuted)


def _letters(text: Column, key: str, tweak: str, undo: bool) -> Column:
    """Permute strings of capital letters of one length among themselves; what is beyond ``_LETTERS`` stays."""
    power = lambda n: F.aggregate(F.sequence(F.lit(0), n), F.lit(1).cast("bigint"), lambda p, i: F.when(i > 0, p * 26).otherwise(p))
    number = lambda t: F.aggregate(F.filter(F.split(t, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda r, c: r * 26 + F.ascii(c) - 65)

    def spelled(value: Column, n: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            letter = F.char(_long(s["rest"] % 26) + 65)
            more = i > 0
            return F.struct(F.when(more, F.concat(letter, s["out"])).otherwise(s["out"]).alias("out"), F.when(more, _long((s["rest"] - s["rest"] % 26).cast("decimal(20,0)") / 26)).otherwise(s["rest"]).alias("rest"))

        return F.aggregate(F.sequence(F.lit(0), n), F.struct(F.lit("").alias("out"), _long(value).alias("rest")), step, lambda s: s["out"])

    def permuted(t: Column) -> Column:
        n = F.least(F.length(t), F.lit(_LETTERS))
        half = F.floor(n / 2).cast("int")
        parts = F.struct(power(half).alias("a"), power(n - half).alias("b"), number(F.substring(t, F.lit(1), half)).alias("x"), number(F.substring(t, half + 1, n - half)).alias("y"))
        out = _let(parts, lambda s: feistel(s["x"], s["y"], s["a"], s["b"], key, tweak, undo))
        return _let(out, lambda o: F.concat(spelled(o["a"], half), spelled(o["b"], n - half), F.substring(t, n + 1, F.length(t))))

    return _let(text, permuted)


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _fill(form: Column, digits: Column, first: str = "0", last: str = "9") -> Column:
    """Put digits, in order, where ``form`` has digits, or other characters where it has those from ``first`` to ``last``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def filled(given: Column) -> Column:
        def step(s: Column, c: Column) -> Column:
            is_digit = c.between(first, last)
            return F.struct(
                F.concat(s["out"], F.when(is_digit, F.substring(given, s["next"], F.lit(1))).otherwise(c)).alias("out"),
                F.when(is_digit, s["next"] + 1).otherwise(s["next"]).alias("next"),
            )

        return F.aggregate(F.split(form, ""), start, step, lambda s: s["out"])

    return _let(digits, filled)


def _luhn(digits: Column, last: int) -> Column:
    """Luhn sum; ``last``: 1 if the check digit is there, 0 if it is still missing."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == last, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)


def _mod97(text: Column) -> Column:
    """Of digits and capital letters, a letter counting as 10 to 35."""
    step = lambda r, c: F.when(c.between("0", "9"), (r * 10 + c.try_cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _card(m: Column, key: str, undo: bool) -> Column:
    def card(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1), _digits(F.substring(d, F.lit(2), n - 2), key, "card", undo))
        new = _let(body, lambda x: F.concat(x, F.pmod(-_luhn(x, 0), F.lit(10)).cast("string")))
        valid = n.between(13, 19) & (_luhn(d, 1) % 10 == 0) & (F.replace(d, F.substring(d, 1, 1), F.lit("")) != "")
        return F.when(valid, _fill(m, new)).otherwise(m)

    return _let(_only_digits(m), card)


def _iban(m: Column, key: str, undo: bool) -> Column:
    """Digits of the account are permuted among digits, letters among letters."""

    def iban(tight: Column) -> Column:
        country, account = F.substring(tight, 1, 2), F.substring(tight, F.lit(5), F.length(tight) - 4)
        figures, capitals = _only_digits(account), F.regexp_replace(account, r"[^A-Z]", "")
        moved = F.struct(
            F.when(F.length(figures) > 1, _digits(figures, key, "iban", undo)).otherwise(figures).alias("digits"),
            F.when(capitals != "", _letters(capitals, key, "iban", undo)).otherwise("").alias("letters"),
        )
        put = lambda form, digits, letters: F.when(letters == "", _fill(form, digits)).otherwise(_fill(_fill(form, digits), letters, "A", "Z"))
        checked = lambda new: F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        valid = _mod97(F.concat(account, country, F.substring(tight, 3, 2))) == 1
        tail = F.substring(m, F.lit(3), F.length(m) - 2)
        new = _let(moved, lambda x: put(tail, F.concat(_let(put(account, x["digits"], x["letters"]), checked), x["digits"]), x["letters"]))
        return F.when(valid, F.concat(country, new)).otherwise(m)

    return _let(F.replace(m, F.lit(" "), F.lit("")), iban)


def _phone(m: Column, key: str, undo: bool) -> Column:
    code = F.regexp_extract(m, rf"^(?:\+|00 ?)(?:[2-9]\d{{0,2}}(?!\d)|{_CODES})", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m) - F.length(code))
    return F.concat(code, _fill(rest, _digits(_only_digits(rest), key, "phone", undo)))


def _american(m: Column, key: str, undo: bool) -> Column:
    """Areas and exchanges from 200; a leading 1 stays."""

    def moved(d: Column) -> Column:
        part = lambda k, n: _long(F.substring(d, F.lit(k), F.lit(n)))
        out = feistel(part(1, 3) - 200, (part(4, 3) - 200) * 10000 + part(7, 4), 800, 8_000_000, key, "american", undo)
        new = _let(out, lambda o: (o["a"] + 200) * 10_000_000 + o["b"] + 2_000_000)
        return F.concat(head, _fill(F.substring(m, F.length(head) + 1, F.length(m)), new.cast("string")))

    head = F.regexp_extract(m, r"^(?:1[ .-])?", 0)
    return _let(F.substring(_only_digits(m), -10, 10), moved)


def _trunk(m: Column, key: str, undo: bool) -> Column:
    """The 0 and the digit after it stay."""
    head = F.regexp_extract(m, r"^\(?0\d", 0)
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    return F.concat(head, _fill(rest, _digits(_only_digits(rest), key, "trunk", undo)))


def _address(m: Column, key: str, undo: bool) -> Column:
    part = [_long(F.split_part(m, F.lit("."), F.lit(k))) for k in (1, 2, 3, 4)]
    out = feistel(part[0] * 256 + part[1], part[2] * 256 + part[3], 65536, 65536, key, "address", undo)
    new = _let(out, lambda o: F.concat_ws(".", F.floor(o["a"] / 256), o["a"] % 256, F.floor(o["b"] / 256), o["b"] % 256))
    return F.when((part[0] < 256) & (part[1] < 256) & (part[2] < 256) & (part[3] < 256), new).otherwise(m)


def _social(m: Column, key: str, undo: bool) -> Column:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001; parted by hyphens or spaces."""
    area, group, serial = (_long(F.split_part(F.translate(m, " ", "-"), F.lit("-"), F.lit(k))) for k in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    out = feistel(place * 99 + group - 1, serial - 1, _AREAS, 9999, key, "social", undo)

    def text(o: Column) -> Column:
        new = F.floor(o["a"] / 99) + 1
        new = new + F.when(new >= 666, 1).otherwise(0)
        written = F.format_string("%03d-%02d-%04d", _long(new), _long(o["a"] % 99 + 1), _long(o["b"] + 1))
        return F.when(m.contains(" "), F.translate(written, "-", " ")).otherwise(written)

    return F.when(valid, _let(out, text)).otherwise(m)


def _date(m: Column, key: str, undo: bool) -> Column:
    """ISO dates, day.month.year and month/day/year, of the years 1700 to 2099. Undone, a date without leading zeros may have them."""
    iso, dots = m.contains("-"), m.contains(".")
    a, b, c = (F.split_part(F.translate(m, "./", "--"), F.lit("-"), F.lit(k)) for k in (1, 2, 3))
    year = F.when(iso, a).otherwise(c)
    month, day = F.when(iso | dots, b).otherwise(a), F.when(iso, c).when(dots, a).otherwise(b)
    date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
    size_a, size_b = _DAYS
    padded = (F.length(a) >= 2) & (F.length(b) >= 2) & (F.length(c) >= 2)

    def text(new: Column) -> Column:
        d, mo = (F.when(padded, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string")) for x in (F.dayofmonth(new), F.month(new)))
        y = F.lpad(F.year(new).cast("string"), 4, "0")
        return F.when(iso, F.concat_ws("-", y, mo, d)).when(dots, F.concat_ws(".", d, mo, y)).otherwise(F.concat_ws("/", mo, d, y))

    # Dots and slashes in one match, or one part short and one long, aren't a date format.
    regular = iso | (F.regexp_count(m, F.lit(r"\.")) == 2) | (F.regexp_count(m, F.lit("/")) == 2)
    return _moved_day(F.when(regular, date), text, m, key, undo)


def _moved_day(date: Column, text: Callable[[Column], Column], m: Column, key: str, undo: bool) -> Column:
    """What a date is moved to, written by ``text``; ``m`` if it is null or out of range."""
    size_a, size_b = _DAYS

    def moved(number: Column) -> Column:
        out = feistel(F.floor(number / size_b), number % size_b, size_a, size_b, key, "date", undo)
        new = _let(out, lambda o: F.date_add(F.lit(_FIRST_DAY).cast("date"), (o["a"] * size_b + o["b"]).cast("int")))
        return F.when(number.between(0, size_a * size_b - 1), _let(new, text)).otherwise(m)

    return _let(_long(F.datediff(date, F.lit(_FIRST_DAY).cast("date"))), moved)


def _named_date(m: Column, key: str, undo: bool) -> Column:
    """12 March 1985 and March 12, 1985."""
    american = m.rlike(r"^\p{L}")
    words = F.split(F.replace(m, F.lit(","), F.lit("")), " ")
    name, day = F.when(american, words[0]).otherwise(words[1]), F.when(american, words[1]).otherwise(words[0])
    names = F.array(*(F.lit(x) for x in MONTHS))
    month = F.array_position(names, name).cast("string")
    date = F.concat_ws("-", words[2], F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")

    def text(new: Column) -> Column:
        d, y = F.dayofmonth(new).cast("string"), F.lpad(F.year(new).cast("string"), 4, "0")
        written = F.element_at(names, F.month(new))
        return F.when(american, F.concat(written, F.lit(" "), d, F.lit(", "), y)).otherwise(F.concat_ws(" ", d, written, y))

    return _moved_day(date, text, m, key, undo)


def _keyed(m: Column, key: str, tweak: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), m), 256)


def _mail(m: Column, key: str) -> Column:
    """Name and host by digests of their own, so that hosts stay linked; the last label of the host stays."""
    host = F.substring_index(m, "@", -1)
    hidden = F.substring(_keyed(F.lower(host), key, "host"), 1, 12)
    return F.concat(F.substring(_keyed(m, key, "mail"), 1, 12), F.lit("@"), hidden, F.lit("."), F.substring_index(host, ".", -1))


def _token(m: Column, key: str) -> Column:
    """A digest of the same length, behind the start that tells whose key it is."""
    start = F.regexp_extract(m, rf"^(?:{KEY_STARTS})", 0)
    digest, n = _keyed(m, key, "token"), F.length(m) - F.length(start)
    written = F.rpad(digest, n, digest)
    return F.concat(start, F.when(start.rlike("^A"), F.upper(written)).otherwise(written))


def pseudonym(match: Column, key: str, undo: bool = False) -> Column:
    """What stands for a match of ``PATTERN``; itself if it isn't valid. Digests can't be undone and stay."""
    mail, token = _mail(match, key), _token(match, key)
    return (
        F.when(match.contains("@"), match if undo else mail)
        .when(match.rlike(r"^[0-9A-Fa-f]{32,}$"), match if undo else token)
        .when(match.rlike(r"^[A-Z]{2}\d"), _iban(match, key, undo))
        .when(match.rlike(r"^\+|^00 ?(?:[2-9]\d{0,2}[ .-]|1 )"), _phone(match, key, undo))
        .when(match.rlike(rf"^(?:{_AMERICAN})$"), _american(match, key, undo))
        .when(match.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"), _address(match, key, undo))
        .when(match.rlike(r"^\d{3}([ -])\d{2}\1\d{4}$"), _social(match, key, undo))
        .when(match.rlike(r"^\d+[./-]\d+[./-]\d+$") & (F.length(match) <= 10) & match.rlike(rf"^(?:{PATTERNS['date']})$"), _date(match, key, undo))
        .when(match.rlike(rf"^(?:\d{{1,2}} )?(?:{_NAMED}) "), _named_date(match, key, undo))
        .when(match.rlike(rf"^(?:{_TRUNK})$"), _trunk(match, key, undo))
        .when(match.rlike(r"^[0-9 -]{13,23}$"), _card(match, key, undo))
        .otherwise(match if undo else token)
    )


def pseudonymise(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """Documents with private values in ``text`` replaced, and how many there were as ``n_private``; all other columns stay.

    Whoever has the ``key`` can undo the pseudonyms of numbers and dates, so there is none by
    default, and an empty one is refused. Texts of any length are looked at whole. Null texts stay null and empty ones empty, with none found. A column that is already called
    ``n_private`` is replaced.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    text = F.col("text")
    found = docs.withColumn("__found", F.when(text.rlike(_MAYBE), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))))
    found = found.withColumn("__new", F.transform("__found", lambda m: pseudonym(m, key, undo)))
    between = F.split(text, PATTERN, -1)
    woven = F.array_join(F.flatten(F.zip_with(between, F.col("__new"), lambda p, x: F.array(p, F.coalesce(x, F.lit(""))))), "")
    changed = F.size(F.filter(F.zip_with("__found", "__new", lambda a, b: a != b), lambda x: x))
    out = found.withColumn("n_private", F.when(F.size("__found") > 0, changed).otherwise(0).cast("bigint"))
    out = out.withColumn("text", F.when(F.col("n_private") > 0, woven).otherwise(text))
    return out.select(*docs.drop("n_private").columns, "n_private")
