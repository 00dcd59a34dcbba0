"""Format-preserving pseudonyms for numbers and dates in texts, in Spark's own functions.

Validated values are replaced by others of the same format: a keyed Feistel network permutes the values of a format, so
equal values get equal pseudonyms in every document (links survive) and different values of one format different ones.

* card numbers: 13 to 19 digits, bare or in groups by one blank or hyphen, that pass the Luhn check.  The leading digit
  stays (it tells the kind), those after it are permuted, the check digit is computed anew.  Numbers may stand next to a
  card (expiry, CVV, quantity): in a run of groups every row of whole groups is tested, the usual groupings first (bare,
  4-4-4-4, 4-6-5, 4-6-4), then from the left the longest that passes.  A run ends where another format begins;
* phone numbers: ``+``, country code and groups of digits: the digits after the country code are permuted.  ``+1`` has ten
  more; others are not extended over a blank once they have nine (eleven with the country code, if that is not set off);
* account numbers: two capitals, two check digits, 11 to 30 capitals or digits, that pass the mod-97 check: what follows
  the check digits is permuted, the check digits are computed anew;
* IPv4 addresses with all parts up to 255: the 32 bits are permuted;
* social security numbers (3-2-4 digits, valid parts): permuted among the valid ones;
* dates that exist, 1900-2099, year first or last: the day is permuted within these 73,049 = 17 x 4,297 days;
* e-mail addresses: letters and digits of the local part are permuted, length, case and other signs stay.

Separators stay and do not count: a number gets the same digits however it is grouped.  What fails validation is left as
it is.  Only texts that hold two digits with at most one blank, dot or hyphen between or an ``@`` are searched (every
format has that); each is cut once at all matches and put together again, so no pseudonym is read a second time.  No
Python on the data, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DEMO_KEY = "demo key, replace it by a secret"

# Formats of personal numbers, tried in this order at each place: (before, format, after).
FORMATS = {
    "email": (r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}", ""),
    "account": (r"(?<![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", r"(?![A-Za-z0-9])"),
    "ip": (r"(?<![0-9]|[0-9]\.)", r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}", r"(?![0-9]|\.[0-9])"),
    "date": (r"(?<![0-9]|[0-9][./-])", r"(?:19|20)[0-9]{2}[./-][0-9]{2}[./-][0-9]{2}|[0-9]{2}[./-][0-9]{2}[./-](?:19|20)[0-9]{2}", r"(?![0-9]|[./-][0-9])"),
    "ssn": (r"(?<![0-9]|[0-9]-)", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?![0-9]|-[0-9])"),
}
_OTHER = "(?!" + "|".join(f"(?:{before}(?:{p}){after})" for before, p, after in FORMATS.values()) + ")"
_DIGIT = "[ ().-]{0,2}[0-9]"
_LONG = r"(?<!\+[0-9]{1,3}(?![0-9])" + 9 * _DIGIT + r"[0-9 ().-]{0,20} |\+" + 11 * _DIGIT + "[0-9 ().-]{0,20} )"      # long enough: no blank more
FORMATS = {
    "email": FORMATS["email"],
    "account": FORMATS["account"],
    "phone": (r"(?<![0-9A-Za-z+])", r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|"
              r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:(?:[.-]| " + _LONG + _OTHER + r")?[0-9]{2,4}){1,4}", r"(?![0-9])"),
    "ip": FORMATS["ip"],
    "date": FORMATS["date"],
    "ssn": FORMATS["ssn"],
    # a run of groups with 13 digits or more: the cards in it are told by their check digits
    "card": (r"(?<![0-9A-Za-z])", r"(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ -]" + _OTHER + r"[0-9]++(?![A-Za-z]))*+", ""),
}
USUAL = ["4-4-4-4", "4-6-5", "4-6-4"]     # and bare
ANY = "|".join(f"(?:{before}(?:{p}){after})" for before, p, after in FORMATS.values())
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digest(key: str, tweak: str, i: int, half: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(tweak), F.lit(str(i)), half, F.lit(key)), 512)


def permute_number(value: Column, a: int, b: int, key: str, tweak: str, back: bool = False) -> Column:
    """A keyed permutation of the whole numbers below a * b: the halves value div b and value mod b get, in turn, a
    keyed function of the other added (modulo a or b).  ``back`` inverts it."""
    def step(i: int):
        def body(s: Column) -> Column:
            other, size = (s["r"], a) if i % 2 == 0 else (s["l"], b)
            add = F.pmod(F.conv(F.substring(_digest(key, tweak, i, other.cast("string")), 1, 15), 16, 10).cast("bigint"), F.lit(size))
            add = -add if back else add
            return F.struct((F.pmod(s["l"] + add, F.lit(a)) if i % 2 == 0 else s["l"]).alias("l"),
                            (F.pmod(s["r"] + add, F.lit(b)) if i % 2 else s["r"]).alias("r"))
        return body

    value = value.cast("bigint")
    state = F.struct(F.floor(value / F.lit(b)).alias("l"), F.pmod(value, F.lit(b)).alias("r"))
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        state = _let(state, step(i))
    return _let(state, lambda s: s["l"] * F.lit(b) + s["r"])


def permute_text(text: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A keyed permutation of the texts of one format: digits stay digits, capitals capitals, small letters small
    letters, other signs stay.  The halves of the text are, in turn, shifted sign by sign by a keyed function of the other
    half.  Up to 128 signs; a single sign is shifted alone.  ``back`` inverts it."""
    def shifted(half: Column, other: Column, i: int) -> Column:
        def sign(c: Column, k: Column, d: Column) -> Column:
            code = F.ascii(c)
            add = F.conv(F.substr(d, 2 * F.pmod(k, F.lit(64)) + 1, F.lit(2)), 16, 10).cast("int") * (-1 if back else 1)

            def within(low: str, n: int) -> Column:
                return F.char(F.lit(ord(low)) + F.pmod(code - F.lit(ord(low)) + add, F.lit(n)))
            return (F.when(c.between("0", "9"), within("0", 10)).when(c.between("a", "z"), within("a", 26))
                    .when(c.between("A", "Z"), within("A", 26)).otherwise(c))
        return _let(_digest(key, tweak, i, F.concat_ws(":", F.length(half).cast("string"), other)),
                    lambda d: F.array_join(F.transform(F.split(half, ""), lambda c, k: sign(c, k, d)), ""))

    def step(i: int):
        def body(s: Column) -> Column:
            return F.struct((shifted(s["l"], s["r"], i) if i % 2 == 0 else s["l"]).alias("l"),
                            (shifted(s["r"], s["l"], i) if i % 2 else s["r"]).alias("r"))
        return body

    n = F.ceil(F.length(text) / 2).cast("int")
    state = F.struct(F.substr(text, F.lit(1), n).alias("l"), F.substr(text, n + 1, F.length(text)).alias("r"))
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        state = _let(state, step(i))
    return _let(state, lambda s: F.concat(s["l"], s["r"]))


def _refill(shape: Column, signs: Column) -> Column:
    """``shape`` with its letters and digits replaced by ``signs`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(shape, ""), start, lambda a, c: F.when(
        c.rlike("^[A-Za-z0-9]$"), F.struct(F.concat(a["out"], F.substr(signs, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))), lambda a: a["out"])


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, "[^A-Za-z0-9]", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit, as text, of the digits before it."""
    each = F.transform(F.reverse(F.split(payload, "")), lambda d, i: F.when(
        F.pmod(i, F.lit(2)) == 0, F.pmod(2 * d.try_cast("int"), F.lit(10)) + F.floor(d.try_cast("int") / F.lit(5))).otherwise(d.try_cast("int")).cast("int"))
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def mod97(value: Column) -> Column:
    """Letters as 10 to 35, then the whole number modulo 97."""
    return F.aggregate(F.split(value, ""), F.lit(0), lambda a, c: F.when(
        c.between("A", "Z"), F.pmod(a * 100 + F.ascii(c) - 55, F.lit(97))).otherwise(F.pmod(a * 10 + F.ascii(c) - 48, F.lit(97))))


def _part(text: Column, first: int, n: int | None = None) -> Column:
    return F.substr(text, F.lit(first), F.lit(n) if n else F.length(text))


def _card(value: Column, key: str) -> Column:
    """The pseudonym of a valid card number."""
    plain = _plain(value)
    return _refill(value, _let(F.concat(_part(plain, 1, 1), permute_text(F.substr(plain, F.lit(2), F.length(plain) - 2), key, "card")),
                               lambda p: F.concat(p, luhn_digit(p))))


def cards(run: Column, key: str) -> Column:
    """struct(out, n): a run of groups of digits with the ``n`` cards in it replaced."""
    def valid(plain: Column) -> Column:
        n = F.length(plain)
        return n.between(13, 19) & (luhn_digit(F.substr(plain, F.lit(1), n - 1)) == F.substr(plain, n, F.lit(1)))

    def row(groups: Column, i: Column, c: Column) -> Column:
        return F.array_join(F.slice(groups, i, c), "")

    def counts(groups: Column, i: Column, most: int) -> Column:
        return F.sequence(F.lit(1), F.least(F.lit(most), F.size(groups) - i + 1))

    def usual(groups: Column, i: Column) -> Column:
        """How many groups from the i-th on are a card in a usual grouping; 0 if none."""
        def fits(c: Column) -> Column:
            shape = F.array_join(F.transform(F.slice(groups, i, c), lambda g: F.length(_plain(g)).cast("string")), "-")
            return ((c == 1) | shape.isin(USUAL)) & valid(_plain(row(groups, i, c)))
        return F.coalesce(F.array_max(F.filter(counts(groups, i, 4), fits)), F.lit(0))

    def other(groups: Column, known: Column, i: Column) -> Column:
        """The same for any grouping that no usual one overlaps; the longest."""
        return F.coalesce(F.array_max(F.filter(counts(groups, i, 19), lambda c: valid(_plain(row(groups, i, c)))
                                               & ~F.exists(F.slice(known, i, c), lambda k: k > 0))), F.lit(0))

    def replaced(groups: Column, known: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"), F.lit(1).alias("next"))

        def step(a: Column, i: Column) -> Column:
            return F.when(i < a["next"], a).otherwise(_let(F.when(F.get(known, i - 1) > 0, F.get(known, i - 1)).otherwise(other(groups, known, i)), lambda c: F.struct(
                F.concat(a["out"], F.when(c > 0, _card(row(groups, i, c), key)).otherwise(F.get(groups, i - 1))).alias("out"),
                (a["n"] + F.when(c > 0, 1).otherwise(0)).alias("n"), (i + F.greatest(c, F.lit(1))).alias("next"))))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda a: F.struct(a["out"].alias("out"), a["n"].alias("n")))

    return _let(F.regexp_extract_all(run, F.lit("[ -]?[0-9]+"), F.lit(0)), lambda groups: _let(
        F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: usual(groups, i)), lambda known: replaced(groups, known)))


def replacement(value: Column, key: str) -> Column:
    """struct(out, n): one match of ``ANY`` with its valid values replaced, and their number."""
    one = _let(pseudonym(value, key), lambda p: F.struct(F.coalesce(p, value).alias("out"), p.isNotNull().cast("int").alias("n")))
    return F.when(value.rlike("^[0-9][0-9 -]{12,}$"), cards(value, key)).otherwise(one)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY`` other than a run of groups with cards; null where the value is not valid."""
    def whole(kind: str) -> Column:
        return value.rlike(f"^(?:{FORMATS[kind][1]})$")

    plain = _plain(value)
    code = F.regexp_extract(value, r"^\+([0-9]{1,3})(?=[^0-9])", 1)
    code = F.when(code == "", _part(plain, 1, 1)).otherwise(code)
    phone = _refill(value, _let(code, lambda c: F.concat(c, permute_text(F.substr(plain, F.length(c) + 1, F.length(plain)), key, "phone"))))
    country = _part(value, 1, 2)
    account = F.when(mod97(F.concat(_part(value, 5), _part(value, 1, 4))) == 1, _let(
        permute_text(_part(value, 5), key, "account"),
        lambda p: F.concat(country, F.lpad((98 - mod97(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"), p)))
    octets = F.transform(F.split(value, r"\."), lambda x: x.try_cast("bigint"))
    ip = F.when(~F.exists(octets, lambda o: F.coalesce(o > 255, F.lit(True))), _let(
        permute_number(F.aggregate(octets, F.lit(0).cast("bigint"), lambda a, o: a * 256 + o), 65536, 65536, key, "ip"),
        lambda n: F.concat_ws(".", *[F.pmod(F.floor(n / F.lit(float(256 ** k))).cast("bigint"), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])))
    n = plain.try_cast("bigint")
    area, group, serial = F.floor(n / F.lit(1e6)), F.pmod(F.floor(n / F.lit(1e4)), F.lit(100)), F.pmod(n, F.lit(10000))
    index = (F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1) * 9999 + serial - 1
    ssn = F.when(area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0), _let(
        permute_number(index, 898 * 99, 9999, key, "ssn"), lambda x: _let(
            F.floor(x / F.lit(99 * 9999)) + 1, lambda a: F.concat_ws(
                "-", F.lpad(F.when(a > 665, a + 1).otherwise(a).cast("string"), 3, "0"),
                F.lpad((F.pmod(F.floor(x / F.lit(9999)), F.lit(99)) + 1).cast("string"), 2, "0"),
                F.lpad((F.pmod(x, F.lit(9999)) + 1).cast("string"), 4, "0")))))

    def date(shape: str) -> Column:
        day = F.try_to_date(plain, shape)
        return F.when(day.isNotNull(), _refill(value, _let(
            permute_number(F.datediff(day, F.lit(FIRST_DAY).cast("date")), *DAYS, key, "date"),
            lambda k: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), k.cast("int")), shape))))

    dates = F.when(value.rlike(r"^(?:19|20)[0-9]{2}[./-]"), date("yyyyMMdd")).otherwise(F.coalesce(date("ddMMyyyy"), date("MMddyyyy")))
    local = F.substring_index(value, "@", 1)
    email = F.concat(_refill(local, permute_text(_plain(local), key, "email")), F.lit("@"), F.substring_index(value, "@", -1))
    return (F.when(F.contains(value, F.lit("@")), email).when(F.startswith(value, F.lit("+")), phone).when(whole("account"), account)
            .when(whole("ip"), ip).when(whole("date"), dates).when(whole("ssn"), ssn))


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the values in ``text`` replaced and ``n_replaced`` added (a former column of that name is replaced).

    Null texts stay null, texts without a valid value stay as they are; repeated rows are treated alike; all other
    columns pass through; an empty table gives an empty table.
    """
    found, new = (next(n for n in (f"{stem}{'_' * i}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for stem in ("_found", "_new"))
    t = F.col(f"`{text}`").cast("string")
    out = docs.withColumn(found, F.when(t.rlike("[0-9][ .-]?[0-9]|@"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))))
    out = out.withColumn(new, F.when(F.size(found) > 0, F.transform(found, lambda m: replacement(m, key))))
    pieces = F.zip_with(F.split(t, ANY, -1), new, lambda a, b: F.concat(a, F.coalesce(b["out"], F.lit(""))))
    return out.withColumns({
        text: F.when(F.size(new) > 0, F.array_join(pieces, "")).otherwise(t),
        "n_replaced": F.coalesce(F.aggregate(new, F.lit(0), lambda a, x: a + x["n"]), F.lit(0)).cast("long"),
    }).drop(found, new)
