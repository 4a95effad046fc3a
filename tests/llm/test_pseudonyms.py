import datetime
import hashlib
import re

from lumbung.llm import pseudonyms as ps

SCHEMA = "doc_id long, text string, n_card string, _kinds2 long"
KEY = "k1"


def sha(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def shift(half, digest):
    out = ""
    for i, c in enumerate(half):
        step = int(digest[i % 32 * 2 : i % 32 * 2 + 2], 16)
        for first, size in ((48, 10), (65, 26), (97, 26)):
            if first <= ord(c) < first + size:
                c = chr((ord(c) - first + step) % size + first)
                break
        out += c
    return out


def text_feistel(value, key):
    left, right = value[: len(value) // 2], value[len(value) // 2 :]
    for n in range(ps.ROUNDS):
        if n % 2 == 0:
            left = shift(left, sha(key, n, len(value), right))
        else:
            right = shift(right, sha(key, n, len(value), left))
    return left + right


def number_feistel(value, a, b, key):
    left, right = divmod(value, b)
    for n in range(ps.ROUNDS):
        if n % 2 == 0:
            left = (left + int(sha(key, n, right)[:12], 16)) % a
        else:
            right = (right + int(sha(key, n, left)[:12], 16)) % b
    return left * b + right


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(value):
    digits = re.sub(r"\D", "", value)

    def put(new):
        new = iter(new)
        return "".join(next(new) if c.isdigit() else c for c in value)

    if "@" in value:
        user, _, host = value.partition("@")
        return text_feistel(user, KEY + "|email") + "@" + host, "email"
    if re.fullmatch(ps.IP, value):
        n = 0
        for p in value.split("."):
            n = n * 256 + int(p)
        n = number_feistel(n, 1 << 16, 1 << 16, KEY + "|ip")
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0)), "ip"
    if re.fullmatch(ps.DATE, value):
        form = "%Y-%m-%d" if value[4] == "-" else "%d.%m.%Y"
        try:
            day = datetime.datetime.strptime(value, form).date()
        except ValueError:
            return value, None
        first = datetime.date(1900, 1, 1)
        return (first + datetime.timedelta(number_feistel((day - first).days, 17, 4297, KEY + "|date"))).strftime(form), "date"
    if re.fullmatch(ps.PHONE, value):
        if not 8 <= len(digits) <= 15:
            return value, None
        m = re.match(r"\+(\d{1,3})(?=[ \-(])", value)
        code = m[1] if m else ""
        return put(code + text_feistel(digits[len(code) :], KEY + "|phone")), "phone"
    if luhn(digits):
        body = text_feistel(digits[:-1], KEY + "|card")
        return put(body + next(c for c in "0123456789" if luhn(body + c))), "card"
    return value, None


TEXTS = [
    "mail anna.b@mail7.example.com, call +1 (068) 555-7713 or 555-123-4567.", "card 4111 1111 1111 1111 and 4111111111111112 no",
    "on 2024-02-29 and 2023-02-29, 31.12.1999 at 10.0.0.1 not 999.1.1.1 or 1.2.3.4.5", "same anna.b@mail7.example.com again 10.0.0.1",
    "4539578763621486 5500-0000-0000-0004", "plain text", "", "é+49 30 1234567é ü.x@y.de", "2099-12-31 1900-01-01 12.13.2020",
]


def test_equals_brute_force(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(50, None, "clash", 1), (0, TEXTS[0], "clash", 1), (None, "10.0.0.1", None, 1), (51, "10.0.0.1 " * 5000, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ps.pseudonymise(df, KEY).collect()
    assert len(got) == len(rows)
    for (doc, text, *_), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, rows[[x[0] for x in rows].index(r.doc_id)][1]))), strict=True):
        kinds = []
        want = None if text is None else re.sub(ps.ANY, lambda m: (lambda x: kinds.append(x[1]) or x[0])(brute(m[0])), text)
        assert r.text == want
        assert [r[f"n_{k}"] for k in ps.KINDS] == [kinds.count(k) for k in ps.KINDS]


def test_formats_hold_and_values_differ(spark):
    cards = [f"{n:015d}" for n in range(41111111, 41111411)]
    cards = [c + next(x for x in "0123456789" if luhn(c + x)) for c in cards]
    days = [(datetime.date(1950, 1, 1) + datetime.timedelta(i * 7)).isoformat() for i in range(300)]
    ips = [f"10.1.{i % 256}.{i // 256}" for i in range(300)]
    df = spark.createDataFrame([(i, f"{a} {b} {c}", "", 1) for i, (a, b, c) in enumerate(zip(cards, days, ips))], SCHEMA)
    out = [r.text.split() for r in ps.pseudonymise(df).collect()]
    for column in zip(*out):
        assert len(set(column)) == 300
    assert all(luhn(a) and len(a) == 16 and datetime.date.fromisoformat(b) and re.fullmatch(ps.IP, c) for a, b, c in out)


def test_empty_table(spark):
    assert ps.pseudonymise(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cards_beside_other_numbers(spark):
    card, grouped = "4111111111111111", "4111 1111 1111 1111"
    body = text_feistel(card[:-1], KEY + "|card")
    new = body + next(c for c in "0123456789" if luhn(body + c))
    apart = " ".join(new[i : i + 4] for i in range(0, 16, 4))
    texts = [(f"{card} 123", f"{new} 123"), (f"{grouped} 12/27", f"{apart} 12/27"), (f"{grouped.replace(' ', '-')}-99 euros", f"{apart.replace(' ', '-')}-99 euros"),
             (f"no 123 {card} end", f"no 123 {new} end"), (f"7 {grouped} 12", f"7 {apart} 12"), ("4111111111111112 123", "4111111111111112 123")]
    df = spark.createDataFrame([(i, t, "", 1) for i, (t, _) in enumerate(texts)], SCHEMA)
    got = ps.pseudonymise(df, KEY).orderBy("doc_id").collect()
    assert [r.text for r in got] == [t for _, t in texts]
    assert [r.n_card for r in got] == [1] * 5 + [0]
