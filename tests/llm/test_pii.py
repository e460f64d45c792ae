"""Pseudonyms against an independent inverse of the permutations, kind by kind."""

import datetime
import hashlib
import random
import re

from pyspark.sql import functions as F

from loomgraph.llm import pii

KEY = "k"


def digest(*parts):
    return int(hashlib.sha256(":".join(map(str, parts)).encode()).hexdigest()[:12], 16)


def back(left, right, a, b, kind):
    """The pair that the network maps to (left, right)."""
    for i in reversed(range(pii.ROUNDS)):
        if i % 2 == 0:
            left = (left - digest(KEY, kind, i, right) % a) % a
        else:
            right = (right - digest(KEY, kind, i, left) % b) % b
    return left, right


def back_digits(text, kind):
    h = len(text) // 2
    left, right = back(int(text[:h] or 0), int(text[h:]), 10**h, 10 ** (len(text) - h), kind)
    return (str(left).zfill(h) if h else "") + str(right).zfill(len(text) - h)


def number(text, base, first):
    out = 0
    for c in text:
        out = out * base + ord(c) - first
    return out


def letters_of(value, n):
    out = ""
    for _ in range(n):
        out, value = chr(97 + value % 26) + out, value // 26
    return out


def back_run(text, kind, one):
    """Runs of 20 characters, one after another."""
    found = ""
    for i in range(0, len(text), 20):
        found += one(text[i : i + 20], f"{kind}:{i // 20}:{found}")
    return found


def back_letters(text, kind):
    upper = text.isupper()

    def one(part, own):
        low, h = part.lower(), len(part) // 2
        left, right = back(number(low[:h], 26, 97), number(low[h:], 26, 97), 26**h, 26 ** (len(low) - h), own)
        found = letters_of(left, h) + letters_of(right, len(low) - h)
        return found.upper() if upper else found

    return back_run(text, kind, one)


def back_classes(value, kind):
    part = lambda pattern: "".join(re.findall(pattern, value))
    small = back_letters(part("[a-z]"), f"{kind}:small")
    large = back_letters(part("[A-Z]"), f"{kind}:large:{small}")
    digits = back_run(part("[0-9]"), f"{kind}:digits:{small}:{large}", back_digits)
    streams = [iter(small), iter(large), iter(digits)]
    return "".join(next(streams[0]) if "a" <= c <= "z" else next(streams[1]) if "A" <= c <= "Z" else next(streams[2]) if "0" <= c <= "9" else c for c in value)


def back_email(value):
    name, host = value.split("@")
    inner, top = host.rsplit(".", 1)
    return f"{back_classes(name, 'email')}@{back_classes(inner, 'host')}.{top}"


def back_secret(value):
    """The other blocks first, by the first one's outcome; then the first, by what follows it."""

    def one(own, kind):
        h = len(own) // 2
        left, right = back(int(own[:h] or "0", 16), int(own[h:], 16), 16**h, 16 ** (len(own) - h), kind)
        return (f"{left:x}".zfill(h) if h else "") + f"{right:x}".zfill(len(own) - h)

    low = value.lower()
    rest = "".join(one(low[i : i + 8], f"secret:{i // 8}:{low[:8]}") for i in range(8, len(low), 8))
    out = one(low[:8], f"secret:{hashlib.sha256(rest.encode()).hexdigest()}") + rest
    return out.upper() if value == value.upper() and re.search("[A-F]", value) else out


def back_date(value):
    year, month, day = map(int, value.split("-"))
    start = (year - 1900) // 200 * 200 + 1900
    leap_years = [y for y in range(start, start + 200) if y % 4 == 0 and (y % 100 or y % 400 == 0)]
    if (month, day) == (2, 29):
        wide, high = (7, 7) if len(leap_years) == 49 else (8, 6)
        i = leap_years.index(year)
        left, right = back(i // wide, i % wide, high, wide, "leap day")
        return f"{leap_years[left * wide + right]:04d}-02-29"
    left, right = back(year - start, (datetime.date(2001, month, day) - datetime.date(2001, 1, 1)).days, 200, 365, "date")
    return f"{left + start:04d}-" + (datetime.date(2001, 1, 1) + datetime.timedelta(right)).strftime("%m-%d")


def back_ip(value):
    a, b, c, d = map(int, value.split("."))
    left, right = back(a * 256 + b, c * 256 + d, 65536, 65536, "ip")
    return ".".join(map(str, (left // 256, left % 256, right // 256, right % 256)))


def back_ssn(value):
    area, group, serial = map(int, value.split("-"))
    left, right = back((area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn")
    place = left // 99 + 1
    return f"{place + (place >= 666):03d}-{left % 99 + 1:02d}-{right + 1:04d}"


def luhn(digits):
    """The check digit that belongs behind digits."""
    total = sum((d * 2 - 9 * (d > 4)) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def back_card(value):
    body = back_digits(value[:-1], "card")
    return body + luhn(body)


def iban_of(country, account):
    shown = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{country}{98 - int(shown) % 97:02d}{account}"


def back_iban(value):
    account = value[4:]
    digits = iter(back_digits("".join(re.findall("[0-9]", account)), "iban"))
    return iban_of(value[:2], "".join(next(digits) if c.isdigit() else c for c in account))


def back_phone(value):
    return "+1" + back_digits(value[2:], "phone")


def values(rng):
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    small, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = small + small.upper() + digits
    for n in (1, 2, 3, 7, 20, 21, 45, 64):
        yield "email", pick(small + digits, n) + "@" + pick(small, rng.randrange(1, 12)) + "." + pick(small + digits, 3) + "." + pick(small, 3), "{}", back_email
    yield "email", "a.b-c_9%x+1@mail3.example.com", "mail {}.", back_email
    for n in (32, 33, 40, 64, 65, 80, 129):
        yield "secret", pick("0123456789abcdef", n - 1) + "7", "api_key={}", back_secret
        yield "secret", pick("0123456789ABCDEF", n - 2) + "A7", "TOKEN: '{}'", back_secret
    for prefix, n in (("ghp_", 36), ("AKIA", 16), ("AIza", 35), ("sk-", 48), ("xoxb-", 24)):
        body = pick(small.upper() + digits if prefix == "AKIA" else every, n)
        yield "token", prefix + body, "use {} here", lambda v, p=prefix: p + back_classes(v[len(p) :], "token")
    for word in ("Hunter2!x9", "p4ssw0rd", "A1b2C3d4E5f6", "x" * 60 + "1"):
        yield "password", word, "password: {}", lambda v: back_classes(v, "password")
    for year, month, day in ((1800, 3, 4), (1904, 2, 29), (2096, 2, 29), (2000, 2, 29), (2023, 2, 28), (2104, 2, 29), (2204, 2, 29), (1796, 2, 29), (1704, 2, 29), (1804, 2, 29), (150, 1, 1), (9899, 12, 31)):
        yield "date", f"{year:04d}-{month:02d}-{day:02d}", "on {}, then", back_date
    for _ in range(6):
        yield "ip", ".".join(str(rng.randrange(256)) for _ in range(4)), "at {} now", back_ip
        yield "ssn", f"{rng.randrange(1, 600):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}", "no {} x", back_ssn
        body = pick(digits[1:], 15)
        yield "card", body + luhn(body), "card {} x", back_card
        yield "iban", iban_of("GB", "WEST" + pick(digits, 14)), "to {} x", back_iban
        yield "phone", "+1" + pick("23456789", 10), "call {} x", back_phone
    yield "ssn", "899-99-9999", "no {} x", back_ssn
    yield "ssn", "667-01-0001", "no {} x", back_ssn


def test_every_kind_can_be_undone_with_the_key(spark):
    rows = list(values(random.Random(5)))
    docs = spark.createDataFrame([(i, form.format(v)) for i, (_, v, form, _) in enumerate(rows)], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.private_values(docs, key=KEY).collect()}
    for i, (kind, value, form, inverse) in enumerate(rows):
        before, after = form.split("{}")
        assert out[i].kinds == kind, (value, out[i])
        made = out[i].text[len(before) : len(out[i].text) - len(after)]
        assert out[i].text == before + made + after and len(made) == len(value) or kind in ("ip",), (value, made)
        want = value.lower() if kind == "email" else value
        assert inverse(made) == want, (kind, value, made)
        assert made != want or len(value) < 8, (kind, value)


def test_secrets_with_a_common_block_share_nothing(spark):
    block, other = "deadbeef", "01234567"
    values = [block * 4 + "1", block * 4 + "2", block * 5, block + other * 3, other * 3 + block, other + block * 3]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", "v", pii.secret(F.col("v"), KEY).alias("p")).collect()
    cut = lambda text: [text[i : i + 8] for i in range(0, len(text), 8) if len(text) >= i + 8]
    blocks = [b for r in rows for b in cut(r.p)]
    assert len(set(blocks)) == len(blocks) and not set(blocks) & {block, other}
    assert all(len(r.p) == len(r.v) and back_secret(r.p) == r.v for r in rows)


def test_small_domains_are_permuted(spark):
    digits = spark.createDataFrame([(i, f"{c}@host.org") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")], "doc_id long, text string")
    made = [r.text for r in pii.private_values(digits, key=KEY).collect()]
    assert len({m.split("@")[0] for m in made}) == 36 and len({m.split("@")[1] for m in made}) == 1


def test_edges(spark):
    long = "x " * 50000 + "10.1.2.3"
    rows = [(1, None, "a"), (2, "", "a"), (3, "plain text 12.5", "a"), (4, long, "a"), (5, "a@b.org", "a"), (5, "a@b.org", "a"), (None, "a@b.org", None), (6, "password: required, key: value1, secret garden", "b"), (7, "9999-01-01 0050-01-01", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found_ string").withColumnRenamed("found_", "FOUND_")
    out = pii.pseudonymize(docs, key=KEY)
    assert out.columns == ["doc_id", "text", "FOUND_", "found__"]
    got = {r[0]: r for r in out.collect()}
    assert len(out.collect()) == len(rows)
    assert got[1].text is None and got[2].text == "" and got[3].text == rows[2][1] and got[6].text == rows[7][1] and got[7].text == rows[8][1]
    assert got[4].found__ == ["ip"] and got[5].text == got[None].text != "a@b.org"
    assert pii.pseudonymize(docs.limit(0), key=KEY).count() == 0
    clash = spark.createDataFrame([(1, "10.1.2.3", 1, 2, 3)], "doc_id long, text string, made_ int, text_ int, found_ int")
    assert pii.pseudonymize(clash, key=KEY).columns == [*clash.columns, "found__"]
    assert pii.key_of(spark) == pii.DEMONSTRATION_KEY
