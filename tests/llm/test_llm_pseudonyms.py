"""Pseudonyms against a plain finder and a plain Feistel network, on texts of any length."""

import hashlib
import random
import re
from datetime import date, timedelta

import pytest

from orrery.llm import pii

KEY = "a key"


def plain_feistel(a, b, most_a, most_b, tweak):
    for i in range(1, 9):
        told = f"{KEY}|{tweak}|{i}|{b if i % 2 else a}"
        drawn = int(hashlib.sha256(told.encode()).hexdigest()[:15], 16)
        if i % 2:
            a = (a + drawn) % most_a
        else:
            b = (b + drawn) % most_b
    return a, b


def plain_digits(x, tweak):
    half = len(x) // 2
    rest = len(x) - half
    a, b = plain_feistel(int(x[:half]), int(x[half:]), 10**half, 10**rest, f"{tweak}{len(x)}")
    return str(a).zfill(half) + str(b).zfill(rest)


def luhn(digits):
    doubled = [2 * int(c) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(n - 9 if n > 9 else n for n in doubled) % 10


def filled(form, digits):
    left = iter(digits)
    return re.sub("[0-9]", lambda _: next(left), form)


def new_card(m):
    digits = re.sub(r"\D", "", m)
    if luhn(digits):
        return None
    body = plain_digits(digits[:-1], "card")
    return filled(m, body + str(-luhn(body + "0") % 10))


def new_ip(m):
    parts = [int(x) for x in m.split(".")]
    if max(parts) > 255:
        return None
    a, b = plain_feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], 65536, 65536, "ip")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def new_date(m):
    try:
        day = date.fromisoformat(m)
    except ValueError:
        return None
    first = date(1800, 1, 1)
    a, b = plain_feistel(*divmod((day - first).days, 773), 189, 773, "date")
    return (first + timedelta(days=a * 773 + b)).isoformat()


def new_ssn(m):
    area, group, serial = map(int, m.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area -= 2 if area > 666 else 1
    a, b = plain_feistel(area * 99 + group - 1, serial - 1, 88802, 9999, "ssn")
    area, group = divmod(a, 99)
    return f"{area + (2 if area >= 665 else 1):03}-{group + 1:02}-{b + 1:04}"


def new_phone(m):
    digits = re.sub(r"\D", "", m)
    code = "" if len(digits) == 10 else "1" if digits[0] == "1" else digits[:2]
    return filled(m, code + plain_digits(digits[len(code):], "phone" + (code or "1")))


PLAIN = [
    (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", new_date),
    (r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", new_ip),
    (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", new_ssn),
    (r"[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{16}", new_card),
    (r"\+1 [0-9]{3} [0-9]{3} [0-9]{4}|\+(?:49|33)[0-9]{9}|\([0-9]{3}\) [0-9]{3}-[0-9]{4}", new_phone),
]


def plainly(text):
    """Items stand between commas; one that is not valid stays as it is."""
    out, n = [], 0
    for item in text.split(" , "):
        new = next((make(item) for form, make in PLAIN if re.fullmatch(form, item)), None)
        out.append(new or item)
        n += new is not None
    return " , ".join(out), n


def drawn_item(rng):
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    card = number(15)
    card += str(-luhn(card + "0") % 10)
    return rng.choice([
        lambda: f"{rng.randint(1800, 2199)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        lambda: "2021-02-30",
        lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        lambda: "300.1.2.x",
        lambda: f"{rng.randint(1, 665):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}",
        lambda: "000-12-3456",
        lambda: card,
        lambda: " ".join(card[i : i + 4] for i in range(0, 16, 4)),
        lambda: "-".join(card[i : i + 4] for i in range(0, 16, 4)),
        lambda: f"+1 {number(3)} {number(3)} {number(4)}",
        lambda: f"+{rng.choice([49, 33])}{number(9)}",
        lambda: f"({number(3)}) {number(3)}-{number(4)}",
        lambda: "w" + number(rng.randint(1, 40)),
        lambda: "plain words",
        lambda: number(rng.randint(1, 6)),
    ])()


@pytest.mark.parametrize("items", [3, 300])
def test_against_a_plain_finder_and_network(spark, items):
    """Long texts hold items on the edges of the blocks in which they are read."""
    rng = random.Random(items)
    texts = [" , ".join(drawn_item(rng) for _ in range(items)) for _ in range(24)]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: (r.pseudonymised, r.n_pii) for r in pii.pseudonymise(table, key=KEY).collect()}
    for text in texts:
        assert got[text] == plainly(text), text


def test_spellings_of_a_number_stay_linked(spark):
    groups = [
        ["+12125550101", "+1 212 555 0101", "+1 (212) 555-0101", "1-212-555-0101",
         "1 (212) 555 0101", "(212) 555-0101", "212-555-0101", "212.555.0101"],
        ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958"],
        ["+35312345678", "+353 1 234 5678"],
    ]
    table = spark.createDataFrame([(g, t) for g, ts in enumerate(groups) for t in ts], "g int, text string")
    kept = {0: "1", 1: "44", 2: "353"}
    seen = {g: set() for g in kept}
    for r in pii.pseudonymise(table, key=KEY).collect():
        assert r.n_pii == 1 and re.sub("[0-9]", "0", r.text) == re.sub("[0-9]", "0", r.pseudonymised)
        digits = re.sub(r"\D", "", r.pseudonymised.replace("(0)", ""))
        if r.text[0] == "+" or r.text[0] == "1":
            assert digits.startswith(kept[r.g])
            digits = digits[len(kept[r.g]):]
        seen[r.g].add(digits)
    assert {g: len(s) for g, s in seen.items()} == {0: 1, 1: 1, 2: 1}


@pytest.mark.parametrize("unit", ["12 ", "1", "12-34.", "a.b@", "+", "(", "GB82 WEST ", "4111 "])
def test_blocks_change_nothing(spark, monkeypatch, unit):
    """Hostile stretches read in blocks give what they give as one block."""
    rng = random.Random(5)
    texts = [
        "".join(unit + rng.choice(["", "", "7", "4111111111111111 ", "x@y.org "]) for _ in range(220))
        for _ in range(3)
    ]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = lambda: sorted((r.text, r.pseudonymised, r.n_pii) for r in pii.pseudonymise(table).collect())
    in_blocks = rows()
    monkeypatch.setattr(pii, "BLOCK", 1 << 20)
    assert rows() == in_blocks
