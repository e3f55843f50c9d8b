"""Format-preserving pseudonyms for personal data, in SQL expressions only.

Numbers and dates that pass their format's validation (card numbers by Luhn,
IBANs by modulo 97, North American telephone and social security numbers by
their ranges, other telephone numbers by + and a country code, IP addresses,
calendar dates, in slashes month first where both readings are dates) are permuted by a keyed Feistel network over the
values of their format.  The result is a valid value of the same format, in
the same layout, and equal values get equal pseudonyms in every document;
with the key the network can be run backwards.  The name part of an e-mail
address becomes a keyed code.  What fails validation stays as it is.

The network works on two numbers x < mx and y < my in turn:
``(x, y) -> (y, (x + H(key, kind, round, y)) mod mx)``, for ``ROUNDS`` rounds
(an even number), H from sha2.

Scale: one projection over the scan, no shuffle and no Python; texts without
a match pass unchanged.

Defined results: a null text stays null and an empty one empty, with no
finds; repeated rows are treated alike; other columns are kept, but one named
like the count column is replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_OPEN, _SHUT = r"(?<![\w.@+-])", r"(?![\w@]|[.-]\w)"
_DATE0 = "1900-01-01"
_DAYS = (17, 4297)                  # their product is the days of 1900 to 2099
#: Country codes of telephone numbers but 1, whose numbers have ranges.
_COUNTRY = r"7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689]\d|3[578]\d|42\d|5[09]\d|6[7-9]\d|" \
           r"8[0578]\d|9[679]\d"
_LETTERS, _BASE26 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789ABCDEFGHIJKLMNOP"
#: Layouts, tried in this order.
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}|"
            r"[A-Z]{2}\d{2} [A-Z0-9]{4}(?: (?=[A-Z]{0,3}\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]{0,2}\d)[A-Z0-9]{1,3})?",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}",
    "date": r"(?:19|20)\d{2}-\d{2}-\d{2}|\d{2}\.\d{2}\.(?:19|20)\d{2}|\d{2}/\d{2}/(?:19|20)\d{2}",
    "phone": r"(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-]?)[2-9]\d{2}[ .-]?\d{4}|"
             rf"\+(?:{_COUNTRY})(?:[ .()-]{{0,2}}\d){{6,12}}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19}",
}
PATTERN = f"{_OPEN}(?:{'|'.join(KINDS.values())}){_SHUT}"


def feistel(x: Column, y: Column, mx: Column, my: Column, kind: str, key: str) -> Column:
    """Struct (x, y) after the network."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), mx.cast("long").alias("mx"),
                     my.cast("long").alias("my"))

    def step(s, r):
        code = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), s["mx"].cast("string"),
                                  s["my"].cast("string"), s["y"].cast("string")), 256)
        h = F.conv(F.substring(code, 1, 15), 16, 10).cast("long")
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + h, s["mx"]).alias("y"), s["my"].alias("mx"),
                        s["mx"].alias("my"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)


def _then(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _pad(n: Column, width) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _permute_digits(d: Column, kind: str, key: str) -> Column:
    """Digits (two to 28) of the same number."""
    n = F.length(d)
    a = F.floor(n / 2).cast("int")
    left, right = F.substring(d, F.lit(1), a), F.substring(d, a + 1, n - a)
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    return _then(feistel(left, right, ten(a), ten(n - a), kind, key),
                 lambda s: F.concat(_pad(s["x"], a), _pad(s["y"], n - a)))


def _permute_letters(s: Column, kind: str, key: str) -> Column:
    """Capitals (one to 26) of the same number, as numbers of base 26."""
    n = F.length(s)
    a = F.floor(n / 2).cast("int")
    digits = F.translate(s, _LETTERS, _BASE26)
    left, right = (F.conv(F.concat(F.lit("0"), x), 26, 10) for x in (
        F.substring(digits, F.lit(1), a), F.substring(digits, a + 1, n - a)))
    size = lambda k: F.conv(F.rpad(F.lit("1"), k + 1, "0"), 26, 10).cast("long")
    show = lambda v, k: F.lpad(F.conv(v.cast("string"), 10, 26), k, "0")
    return _then(feistel(left, right, size(a), size(n - a), kind, key), lambda t: F.translate(
        F.concat(show(t["x"], a), show(t["y"], n - a)), _BASE26, _LETTERS))


def _lay_out(m: Column, d: Column, replaced: str = "^[0-9]$") -> Column:
    """The match with its digits (or what is ``replaced``) replaced by those of ``d``, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s, c):
        digit = c.rlike(replaced)
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(d, s["at"], F.lit(1))).otherwise(c)).alias("out"),
                        (s["at"] + digit.cast("int")).alias("at"))
    return F.aggregate(F.split(m, ""), start, step)["out"]


def _luhn_sum(d: Column, doubled_from_end: int) -> Column:
    """Luhn sum in which every second digit counts double, beginning with
    the given place from the end."""
    back = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(
        F.pmod(i + 1 - doubled_from_end, F.lit(2)) == 0,
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(
        c.cast("int")))
    return F.aggregate(back, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = F.substring(d, F.lit(1), F.length(d) - 1)
    new = _then(_permute_digits(body, "card", key), lambda b: F.concat(
        b, F.pmod(10 - F.pmod(_luhn_sum(b, 1), F.lit(10)), F.lit(10)).cast("string")))
    return F.when(F.pmod(_luhn_sum(d, 2), F.lit(10)) == 0, _then(new, lambda n: _lay_out(m, n)))


def _rest97(s: Column) -> Column:
    """Remainder by 97 of digits and capitals, which count 10 to 35."""
    def step(a, c):
        v = F.call_function("instr", F.lit(f"0123456789{_LETTERS}"), c) - 1
        return F.when(c == "", a).when(v < 10, (a * 10 + v) % 97).otherwise((a * 100 + v) % 97)
    return F.aggregate(F.split(s, ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    """Digits are permuted among the digits of the account part, capitals
    among its capitals."""
    flat = F.regexp_replace(m, " ", "")
    country, check, body = F.substring(flat, 1, 2), F.substring(flat, 3, 2), F.substring(flat, 5, 40)
    digits, letters = _digits(body), F.regexp_replace(body, "[0-9]", "")
    new = _then(
        F.struct(F.when(F.length(digits) > 1, _permute_digits(digits, "iban", key)).otherwise(digits).alias("d"),
                 F.when(F.length(letters) > 0, _permute_letters(letters, "iban-letters", key)).otherwise("").alias("l")),
        lambda n: F.concat(country, F.lit("00"), _lay_out(_lay_out(body, n["d"]), n["l"], "^[A-Z]$")))
    checked = _then(new, lambda n: F.concat(
        country, _pad(98 - _rest97(F.concat(F.substring(n, 5, 40), F.substring(n, 1, 4))), 2), F.substring(n, 5, 40)))
    # 26 capitals at most fill two longs
    valid = (F.length(flat) <= 34) & (F.length(letters) <= 26) & (_rest97(F.concat(body, country, check)) == 1)
    return F.when(valid, _then(checked, lambda n: _lay_out(_lay_out(m, _digits(n)), F.regexp_replace(n, "[0-9]", ""),
                                                           "^[A-Z]$")))


def _ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda c: c.cast("long"))
    half = lambda k: o[k] * 256 + o[k + 1]
    new = _then(feistel(half(0), half(2), F.lit(65536), F.lit(65536), "ip", key), lambda s: F.concat_ws(
        ".", *[x.cast("string") for h in ("x", "y") for x in (F.floor(s[h] / 256), s[h] % 256)]))
    return F.when(F.forall(o, lambda x: x <= 255), new)


def _phone(m: Column, key: str) -> Column:
    return F.when(m.rlike(r"^\+[2-9]"), _phone_abroad(m, key)).otherwise(_phone_america(m, key))


def _phone_america(m: Column, key: str) -> Column:
    d = _digits(m)
    ten = F.substring(d, F.length(d) - 9, F.lit(10))
    part = lambda k: F.substring(ten, k, 3).cast("long") - 200
    new = _then(feistel(part(1) * 800 + part(4), F.substring(ten, 7, 4), F.lit(640000), F.lit(10000), "phone", key),
                lambda s: F.concat(F.substring(d, F.lit(1), F.length(d) - 10),
                                   (F.floor(s["x"] / 800) + 200).cast("string"), (s["x"] % 800 + 200).cast("string"),
                                   _pad(s["y"], 4)))
    return _then(new, lambda n: _lay_out(m, n))


def _phone_abroad(m: Column, key: str) -> Column:
    """The country code stays; a number that begins with 1 to 9 keeps doing so."""
    d = _digits(m)
    code = F.regexp_extract(d, f"^({_COUNTRY})", 1)
    number = F.substring(d, F.length(code) + 1, F.length(d) - F.length(code))
    n = F.length(number)
    a = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    least = F.when(number.startswith("0"), F.lit(0).cast("long")).otherwise(ten(a - 1))
    count = F.when(number.startswith("0"), ten(a - 1)).otherwise(9 * ten(a - 1))
    left, right = F.substring(number, F.lit(1), a).cast("long") - least, F.substring(number, a + 1, n - a)
    new = _then(feistel(left, right, count, ten(n - a), "phone-abroad", key), lambda s: F.concat(
        code, _pad(s["x"] + least, a), _pad(s["y"], n - a)))
    return F.when(F.length(d) <= 15, _then(new, lambda x: _lay_out(m, x)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split(m, "-")[k].cast("long") for k in range(3))
    place = F.when(area > 666, area - 2).otherwise(area - 1)            # 1 to 899 without 666
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)

    def show(s):
        a = F.floor(s["x"] / 99)
        return F.concat_ws("-", _pad(F.when(a >= 665, a + 2).otherwise(a + 1), 3), _pad(s["x"] % 99 + 1, 2),
                           _pad(s["y"] + 1, 4))
    return F.when(valid, _then(feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), "ssn", key),
                               show))


def _date(m: Column, key: str) -> Column:
    zero = F.lit(_DATE0).cast("date")
    number = lambda s: s["x"] * _DAYS[1] + s["y"]
    shift = lambda n: feistel(F.floor(n / _DAYS[1]), n % _DAYS[1], F.lit(_DAYS[0]), F.lit(_DAYS[1]), "date",
                              key)

    def shown(layout, again=lambda n: n):
        day = F.datediff(F.try_to_timestamp(m, F.lit(layout)).cast("date"), zero)
        return _then(day, lambda n: _then(again(number(shift(n))), lambda k: F.date_format(
            F.date_add(zero, k.cast("int")), layout)))

    def walk(n):
        """On until the day is above 12, so that day-first dates stay so (each step ends it with odds of 0.6)."""
        return F.aggregate(F.sequence(F.lit(1), F.lit(80)), n.cast("long"), lambda k, _: F.when(
            F.dayofmonth(F.date_add(zero, k.cast("int"))) > 12, k).otherwise(number(shift(k)).cast("long")))
    out = None
    for sign, layout, again in (("-", "yyyy-MM-dd", None), (".", "dd.MM.yyyy", None), ("/", "MM/dd/yyyy", None),
                                ("/", "dd/MM/yyyy", walk)):
        here = F.contains(m, F.lit(sign)) & (F.try_to_timestamp(m, F.lit(layout)).isNotNull())
        out = (F if out is None else out).when(here, shown(layout, again) if again else shown(layout))
    return out


def _email(m: Column, key: str) -> Column:
    code = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 12)
    return F.concat(F.lit("user-"), code, F.lit("@"), F.regexp_extract(m, "@(.*)$", 1))


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of a match of ``PATTERN``; null if it is not valid."""
    make = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}
    out = None
    for kind, layout in KINDS.items():
        fits = m.rlike(f"^(?:{layout})$")
        out = F.when(fits, make[kind](m, key)) if out is None else out.when(fits, make[kind](m, key))
    return out


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", count: str = "n_private") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and ``count``
    values that were."""
    t = F.col(f"`{text}`")
    found = F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))
    # a cheap look at the text first: every layout has four digits or an @
    likely = t.rlike(r"@|\d{3}|\d\.\d|\+\d")
    pairs = F.transform(found, lambda m: F.struct(m.alias("m"), pseudonym(m, key).alias("p")))
    other = [c for c in docs.columns if c not in (count, text)]
    at = docs.withColumns({"_pairs": F.when(likely, pairs), "_parts": F.when(likely, F.split(t, PATTERN, -1))})
    whole = F.concat(F.array_join(F.zip_with(
        F.slice("_parts", F.lit(1), F.size("_pairs")), F.col("_pairs"),
        lambda a, b: F.concat(a, F.coalesce(b["p"], b["m"]))), ""), F.element_at("_parts", -1))
    some = F.coalesce(F.size("_pairs") > 0, F.lit(False))
    changed = F.when(some, whole).otherwise(t).alias(text)
    n = F.when(some, F.size(F.filter("_pairs", lambda x: x["p"].isNotNull()))).otherwise(0).cast("long").alias(count)
    order = [changed if c == text else F.col(f"`{c}`") for c in docs.columns if c in other or c == text]
    return at.select(*order, n)
