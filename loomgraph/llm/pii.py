"""Private values become format-preserving Feistel pseudonyms, with DataFrame functions alone.

One pattern finds candidates in the whole text; each is validated (Luhn for cards, modulo 97 for IBANs, octets for IP
addresses, calendar for dates, ranges for social security and telephone numbers) and, if valid, permuted by a keyed
Feistel network within the values of its own format. So a pseudonym is again a valid value of the same kind and layout,
different values get different pseudonyms, and equal values stay linked across documents, however they are punctuated.
Candidates that fail validation stay as they are.

The network alternates L = (L + F(R)) mod a and R = (R + F(L)) mod b over pairs in [0, a) x [0, b), ROUNDS times, which
is a bijection for any a and b; F is taken from SHA-256 of key, kind, round and value. Kinds and their domains:

- card: 13 to 19 digits; all but the last are permuted, the last is the check digit again;
- iban: country and letters stay, digits of the account are permuted, check digits are made again;
- ip: all four octets; ssn: areas 001-899 but 666, groups 01-99, serials 0001-9999;
- phone: country code stays (+1, or what stands before the first separator), other digits are permuted;
- date: days of the same two centuries (1900-2099 and so on, years 100 to 9899), 29 February among themselves, printed
  in the same layout;
- secret: 32 or more hexadecimal digits of assigned tokens, eight at a time and then the rest; capitals if all letters are;
- token: well-known prefixes of access tokens stay, and so does the layout; small letters, capitals and digits after them
  are permuted among themselves;
- password: as token, for what is assigned to a password, secret, token or the like and has letters and digits;
- email: by the lower-cased address; letters and digits of the name are permuted within its layout, and so are those of
  the host up to its last dot.

Letters and digits of tokens, passwords and addresses are permuted in runs of at most 20 at a time; what was permuted
before takes part in the key of what follows, so the whole stays a bijection. A value of one character of a kind is
only shifted. Null texts stay null; empty texts and texts without candidates stay as they are. Repeated rows give
repeated results. The key has to be given: who has it can undo all of this.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm.common import free_names
from loomgraph.llm.licenses import let

ROUNDS = 8
#: Setting that holds the key, and the key of demonstrations, which hides nothing.
KEY_SETTING, DEMONSTRATION_KEY = "spark.loomgraph.pseudonymKey", "a demonstration, not a secret"
START, STOP = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
NUMBER_START, NUMBER_STOP = r"(?<![\p{L}\p{N}_.+/-])", r"(?![\p{L}\p{N}_]|[./-]\p{N})"
#: An address may follow // or a blank and /, or another one and a dash; a path, a prefix length or a range may follow it.
IP_START, IP_STOP = rf"(?:{NUMBER_START}|(?<=//|\s/|\.[0-9]{{1,3}}-))", r"(?![\p{L}\p{N}_]|\.\p{N})"
#: A date may stand before a time or zone, in a path or an interval, and at either end of a range of its own layout.
ISO, LOCAL = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4}"
TIME = r"(?=[Tt][0-9]{2}|[Zz](?![\p{L}\p{N}_]))"
ISO_START, ISO_STOP = rf"(?:{NUMBER_START}|(?<=/|{ISO}-))", rf"(?:(?![\p{{L}}\p{{N}}_]|[.-]\p{{N}})|{TIME}|(?=-{ISO}(?!\p{{N}})))"
LOCAL_START, LOCAL_STOP = rf"(?:{NUMBER_START}|(?<={LOCAL}-))", rf"(?:{NUMBER_STOP}|{TIME}|(?=-{LOCAL}(?!\p{{N}})))"
PATTERNS = {
    "email": START + r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,4}\.[A-Za-z]{2,24}" + STOP,
    "secret": r"(?=[0-9a-fA-F]{32})(?<=(?i:token|secret|passwd|password|api_key|apikey|key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,}" + STOP,
    # 32 and more hexadecimal digits are no account: no country whose letters are A to F has such long ones
    "token": START + r"(?:gh[pousr]_[A-Za-z0-9]{20,255}|(?:AKIA|ASIA)[0-9A-Z]{16}|AIza[0-9A-Za-z_-]{35}|sk-[A-Za-z0-9_-]{20,255}|xox[abprs]-[0-9A-Za-z-]{10,255})(?![A-Za-z0-9_])",
    # what stands before is looked at in three steps, from cheap to dear
    "password": r"(?<=[=:\"'\s])(?<=[=:]\s{0,3}[\"']?)(?=\S{6})(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey|access_key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?![\s\"'=:]|[0-9a-fA-F]{32,}(?![\p{L}\p{N}_]))(?=[^\s\"',;<>]*[0-9])(?=[^\s\"',;<>]*[A-Za-z])[^\s\"',;<>]{6,255}",
    "iban": START + r"(?![0-9A-F]{32,}(?![\p{L}\p{N}_]))[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + STOP,
    "ip": IP_START + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + IP_STOP,
    "date": rf"(?:{ISO_START}{ISO}{ISO_STOP}|{LOCAL_START}[0-9]{{1,2}}([/.])[0-9]{{1,2}}\1[0-9]{{4}}{LOCAL_STOP})",
    "card": NUMBER_START + r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{5})" + NUMBER_STOP,
    "ssn": NUMBER_START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + NUMBER_STOP,
    "phone": r"(?<![\p{L}\p{N}_+.-])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[2-9][0-9]{0,2}[ -]?(?:\([0-9]{1,4}\)[ -]?)?[0-9]{2,4}(?:[ -]?[0-9]{2,4}){1,3}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + STOP,
}
#: The kinds in the order in which a found value is tried, each by its own characters.
SHAPES = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$",
    "token": r"^(?:gh[pousr]_|AKIA|ASIA|AIza|sk-|xox[abprs]-)[A-Za-z0-9_-]{10,}$",
    "secret": r"^[0-9a-fA-F]{32,}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?$",
    "ip": r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$",
    "date": r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\1[0-9]{4})$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "phone": r"^[+(0-9][0-9(). +-]*$",
    "password": "",
}
TOKEN_PREFIX = "^(?:gh[pousr]_|AKIA|ASIA|AIza|sk-|xox[abprs]-)"
ANY = "|".join(PATTERNS.values())


def long(value: Column | int) -> Column:
    return value.cast("long") if isinstance(value, Column) else F.lit(value).cast("long")


def digest(key: str, *parts: Column | str) -> Column:
    """48 bits of SHA-256 of the parts, as long."""
    text = F.concat_ws(":", F.lit(key), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str, kind: Column | str) -> Column:
    """struct(l, r): the pair's place in the keyed permutation of [0, a) x [0, b)."""
    a, b = long(a), long(b)

    def turn(pair: Column, i: Column) -> Column:
        l, r = pair.getField("l"), pair.getField("r")  # noqa: E741
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(l + F.pmod(digest(key, kind, i, r), a), a)).otherwise(l).alias("l"),
            F.when(even, r).otherwise(F.pmod(r + F.pmod(digest(key, kind, i, l), b), b)).alias("r"),
        )

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), F.struct(long(left).alias("l"), long(right).alias("r")), turn)


def padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, F.lit("0"))


def permute_digits(digits: Column, key: str, kind: Column | str) -> Column:
    """A string of 1 to 36 digits, permuted among those of its length."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")
    left = F.when(half > 0, F.substring(digits, F.lit(1), half)).otherwise("0")
    pair = feistel(left, F.substring(digits, half + 1, n - half), size(half), size(n - half), key, kind)
    return let(pair, lambda p: F.concat(F.when(half > 0, padded(p.getField("l"), half)).otherwise(""), padded(p.getField("r"), n - half)))


def permute_letters(letters: Column, key: str, kind: Column) -> Column:
    """A string of small letters or capitals, permuted among those of its length and case, 20 letters at a time."""
    low, high = "abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOP"  # as digits of base 26

    def run(i: Column) -> Column:
        own = F.translate(F.lower(F.substring(letters, i * 20 + 1, F.lit(20))), low, high)
        n = F.length(own)
        half = (n / 2).cast("int")
        number = lambda x: F.conv(F.concat(F.lit("0"), x), 26, 10).cast("long")
        size = lambda k: F.pow(F.lit(26.0), k).cast("long")
        show = lambda v, k: F.when(k > 0, F.lpad(F.conv(v.cast("string"), 10, 26), k, F.lit("0"))).otherwise("")
        pair = feistel(number(F.substring(own, F.lit(1), half)), number(F.substring(own, half + 1, n - half)), size(half), size(n - half), key, F.concat_ws(":", kind, i.cast("string"), F.substring(letters, F.lit(1), i * 20)))
        return let(pair, lambda p: F.translate(F.concat(show(p.getField("l"), half), show(p.getField("r"), n - half)), high, low))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.length(letters) / 20).cast("int") - 1), run), "")
    cased = F.when(letters.rlike("^[A-Z]"), F.upper(made)).otherwise(made)
    return F.when(F.length(letters) == 0, F.lit("")).otherwise(cased)


def permute_long_digits(digits: Column, key: str, kind: Column) -> Column:
    """A string of any number of digits, 20 at a time."""

    def run(i: Column) -> Column:
        own = F.substring(digits, i * 20 + 1, F.lit(20))
        return permute_digits(own, key, F.concat_ws(":", kind, i.cast("string"), F.substring(digits, F.lit(1), i * 20)))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(F.length(digits) / 20).cast("int") - 1), run), "")
    return F.when(F.length(digits) == 0, F.lit("")).otherwise(made)


def permute_classes(value: Column, key: str, kind: str) -> Column:
    """Small letters, capitals and digits of a value, each permuted among themselves; other characters stay."""
    part = lambda c: F.regexp_replace(value, f"[^{c}]", "")
    small, large, digits = part("a-z"), part("A-Z"), part("0-9")
    seed = F.lit(kind)
    out = into_layout(value, permute_letters(small, key, F.concat_ws(":", seed, F.lit("small"))), "[a-z]")
    out = into_layout(out, permute_letters(large, key, F.concat_ws(":", seed, F.lit("large"), small)), "[A-Z]")
    return into_layout(out, permute_long_digits(digits, key, F.concat_ws(":", seed, F.lit("digits"), small, large)), "[0-9]")


def into_layout(layout: Column, chars: Column, kind: str) -> Column:
    """The layout with its characters of a kind ([0-9] or the like) replaced by chars, one after another."""
    gaps = F.split(layout, kind, -1)
    each = F.split(chars, "")
    return F.array_join(F.zip_with(gaps, each, lambda g, c: F.concat(g, F.coalesce(c, F.lit("")))), "")


def luhn_sum(digits: Column, *, from_right: int) -> Column:
    """Luhn sum; the digit that stands from_right places from the right end (0: last) is the first."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((i + from_right) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def mod97(text: Column) -> Column:
    """A string of capitals and digits modulo 97, letters as 10 to 35."""

    def step(total: Column, c: Column) -> Column:
        value = F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (F.when(value > 9, total * 100).otherwise(total * 10) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[ -]", "")
    body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = let(body, lambda b: F.concat(b, ((10 - luhn_sum(b, from_right=1) % 10) % 10).cast("string")))
    return F.when(luhn_sum(digits, from_right=0) % 10 == 0, into_layout(value, whole, "[0-9]"))


def iban(value: Column, key: str) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    account, country = F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 2)
    valid = (F.length(plain).between(15, 34)) & (mod97(F.concat(account, F.substring(plain, 1, 4))) == 1)
    digits = F.regexp_replace(account, "[^0-9]", "")
    changed = into_layout(account, permute_digits(digits, key, "iban"), "[0-9]")
    check = lambda x: padded(98 - mod97(F.concat(x, country, F.lit("00"))), 2)
    whole = let(changed, lambda x: F.concat(country, check(x), x))
    return F.when(valid & (F.length(digits) >= 2), into_layout(value, whole, "[A-Z0-9]"))


def ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    at = lambda i: F.get(octets, F.lit(i))
    pair = feistel(at(0) * 256 + at(1), at(2) * 256 + at(3), 65536, 65536, key, "ip")
    parts = lambda p: [(p.getField(f) / 256).cast("int") if high else p.getField(f) % 256 for f in "lr" for high in (True, False)]
    return F.when(F.array_max(octets) <= 255, let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for x in parts(p)])))


def ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = feistel(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")

    def show(p: Column) -> Column:
        place = (p.getField("l") / 99).cast("int")
        new_area = place + 1 + F.when(place + 1 >= 666, 1).otherwise(0)
        return F.concat_ws("-", padded(new_area, 3), padded(p.getField("l") % 99 + 1, 2), padded(p.getField("r") + 1, 4))

    return F.when(valid, let(pair, show))


def phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^\+(?:1|[2-9][0-9]{0,2}(?=[ (-])|[2-9][0-9])", 0)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    digits = F.regexp_replace(rest, "[^0-9]", "")
    total = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return F.when(total.between(8, 15) & (F.length(digits) >= 6), F.concat(code, into_layout(rest, permute_digits(digits, key, "phone"), "[0-9]")))


def date(value: Column, key: str) -> Column:
    iso = value.rlike("^[0-9]{4}-")
    parts = F.split(value, "[-/.]")
    part = lambda i: F.get(parts, F.lit(i)).cast("int")
    year = F.when(iso, part(0)).otherwise(part(2))
    swapped = ~iso & (part(1) > 12)  # month first
    month = F.when(iso | ~swapped, part(1)).otherwise(part(0))
    day = F.when(iso, part(2)).when(swapped, part(1)).otherwise(part(0))
    real = F.try_to_date(F.concat_ws("-", padded(year, 4), padded(month, 2), padded(day, 2)), "yyyy-MM-dd")
    leap = (month == 2) & (day == 29)
    # day of a year without 29 February, from 0
    ordinary = F.date_diff(F.make_date(F.lit(2001), month, F.when(leap, 28).otherwise(day)), F.lit("2001-01-01").cast("date"))
    start = (F.floor((year - 1900) / 200) * 200 + 1900).cast("int")  # two centuries from here
    gap = F.when((start + 100) % 400 == 0, 0).otherwise(1)  # 1 if the second century's first year is no leap year
    late = year > start + 100 + F.when(gap == 0, -1).otherwise(0)
    index = ((year - start) / 4).cast("int") - 1 - F.when(late, gap).otherwise(0)
    wide = F.when(gap == 0, 7).otherwise(8)  # 49 or 48 leap years
    usual = feistel(year - start, ordinary, 200, 365, key, "date")
    rare = feistel((index / wide).cast("int"), index % wide, F.when(gap == 0, 7).otherwise(6), wide, key, "leap day")
    plain = lambda p: F.struct((p.getField("l") + start).cast("int").alias("y"), F.date_add(F.lit("2001-01-01").cast("date"), p.getField("r").cast("int")).alias("d"))

    def other(p: Column) -> Column:
        i = p.getField("l") * wide + p.getField("r")
        return F.struct((start + 4 * (i + 1 + F.when(i >= 24, gap).otherwise(0))).cast("int").alias("y"), F.lit("2000-02-29").cast("date").alias("d"))

    def show(x: Column) -> Column:
        y, m, d = x.getField("y"), F.month(x.getField("d")), F.day(x.getField("d"))
        two = lambda i, v: F.when(F.length(F.get(parts, F.lit(i))) == 2, padded(v, 2)).otherwise(v.cast("string"))
        first, second = F.when(swapped, m).otherwise(d), F.when(swapped, d).otherwise(m)
        dot = F.regexp_extract(value, "[/.]", 0)
        return F.when(iso, F.concat_ws("-", padded(y, 4), padded(m, 2), padded(d, 2))).otherwise(F.concat(two(0, first), dot, two(1, second), dot, padded(y, 4)))

    return F.when(real.isNotNull() & year.between(100, 9899), let(F.when(leap, let(rare, other)).otherwise(let(usual, plain)), show))


def secret(value: Column, key: str) -> Column:
    """Blocks of eight digits and what is left, each permuted in whatever case they are. The first block's permutation
    depends on all that follows it, and every other's on its place and the first one's outcome: a block that two secrets
    share, or that one repeats, looks different each time, and the whole can still be undone with the key."""
    low, n = F.lower(value), F.length(value)
    last = F.ceil(n / 8).cast("int") - 1

    def block(own: Column, kind: Column) -> Column:
        half = (F.length(own) / 2).cast("int")
        rest = F.length(own) - half
        number = lambda x: F.conv(F.concat(F.lit("0"), x), 16, 10).cast("long")
        size = lambda k: F.pow(F.lit(16.0), k).cast("long")
        pair = feistel(number(F.substring(own, F.lit(1), half)), number(F.substring(own, half + 1, rest)), size(half), size(rest), key, kind)
        show = lambda v, k: F.when(k > 0, F.lpad(F.lower(F.hex(v)), k, F.lit("0"))).otherwise("")
        return let(pair, lambda p: F.concat(show(p.getField("l"), half), show(p.getField("r"), rest)))

    def others(first: Column) -> Column:
        places = F.slice(F.sequence(F.lit(0), last), F.lit(2), last)
        each = F.transform(places, lambda i: block(F.substring(low, i * 8 + 1, F.lit(8)), F.concat_ws(":", F.lit("secret"), i.cast("string"), first)))
        return F.concat(first, F.array_join(each, ""))

    first = block(F.substring(low, F.lit(1), F.lit(8)), F.concat_ws(":", F.lit("secret"), F.sha2(F.substring(low, F.lit(9), n), 256)))
    made = let(first, others)
    return F.when(value.rlike("[A-F]") & ~value.rlike("[a-f]"), F.upper(made)).otherwise(made)


def email(value: Column, key: str) -> Column:
    low = F.lower(value)
    host = F.substring_index(low, "@", -1)
    top = F.concat(F.lit("."), F.substring_index(host, ".", -1))
    inner = F.substring(host, F.lit(1), F.length(host) - F.length(top))
    return F.concat(permute_classes(F.substring_index(low, "@", 1), key, "email"), F.lit("@"), permute_classes(inner, key, "host"), top)


def token(value: Column, key: str) -> Column:
    prefix = F.regexp_extract(value, TOKEN_PREFIX, 0)
    return F.concat(prefix, permute_classes(F.substring(value, F.length(prefix) + 1, F.length(value)), key, "token"))


def password(value: Column, key: str) -> Column:
    return permute_classes(value, key, "password")


MAKERS: dict[str, Callable[[Column, str], Column]] = {"email": email, "token": token, "password": password, "secret": secret, "iban": iban, "ip": ip, "date": date, "card": card, "ssn": ssn, "phone": phone}


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, text): the pseudonym of a found value; kind is null and text the value where it isn't valid."""
    kind, made = None, None
    for name, shape in SHAPES.items():
        test = value.rlike(shape)
        kind = F.when(test, name) if kind is None else kind.when(test, name)
        made = F.when(test, MAKERS[name](value, key)) if made is None else made.when(test, MAKERS[name](value, key))
    return let(made, lambda m: F.struct(F.when(m.isNotNull(), kind).alias("kind"), F.coalesce(m, value).alias("text")))


def key_of(spark: SparkSession) -> str:
    """The key that the session's ``KEY_SETTING`` holds; without one, that of demonstrations, with a warning."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        logging.getLogger(__name__).warning("%s is unset: pseudonyms with the key of demonstrations can be undone by anyone", KEY_SETTING)
    return key or DEMONSTRATION_KEY


def pseudonymize(docs: DataFrame, *, key: str, kinds: str = "found_") -> DataFrame:
    """docs with pseudonyms in text, and a last column kinds: the kinds of the values replaced, in order. If docs has a
    column of this name, the new one's is longer by underscores."""
    none = F.array().cast("array<string>")
    made_, text_, kinds_ = free_names(docs, "made_", "text_", kinds)
    made = F.transform(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), lambda v: pseudonym(v, key))
    # every pattern needs a digit or an @
    found = docs.withColumn(made_, F.when(F.col("text").rlike("[0-9@]"), made))
    news = F.transform(made_, lambda m: m.getField("text"))
    text = F.array_join(F.zip_with(F.split("text", ANY, -1), news, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    own = F.filter(F.transform(made_, lambda m: m.getField("kind")), lambda k: k.isNotNull())
    out = found.withColumn(text_, F.when(F.coalesce(F.size(made_), F.lit(0)) <= 0, F.col("text")).otherwise(text)).withColumn(kinds_, F.coalesce(own, none))
    return out.select(*[F.col(text_).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], kinds_)


def private_values(docs: DataFrame, *, key: str) -> DataFrame:
    """doc_id, n_private (values replaced), kinds (distinct, sorted, comma-joined) and the new text of each row."""
    out = pseudonymize(docs.select("doc_id", "text"), key=key)
    return out.select("doc_id", F.size("found_").cast("long").alias("n_private"), F.array_join(F.array_sort(F.array_distinct("found_")), ",").alias("kinds"), "text")
