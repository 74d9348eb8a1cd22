"""Personal data replaced by keyed pseudonyms of the same format, in SQL functions only.

A text is cut at everything that looks like personal data. Where a candidate is not
valid, its shorter prefixes that end at a separator are tried, then the later starts
inside it. What passes its kind's validation is permuted by a Feistel network over its own digits, keyed and marked by
kind; so equal values get equal pseudonyms in every document, different values of
a kind and length get different ones, and nothing has to be looked up or joined.

=======  =====================================================  ==========================
kind     valid                                                  kept
=======  =====================================================  ==========================
email    local part and dotted host                             host, punctuation
iban     letters, length and remainder 97                       country; new check digits
date     a day of the calendar, 1800 to 2199                    notation; again a valid day
ip       four numbers up to 255                                 again a valid address
ssn      no reserved area, group or serial                      punctuation
card     13 to 19 digits with a right check digit               length; new check digit
phone    7 to 15 digits with a country code or in 3-3-4 form    country code, punctuation
=======  =====================================================  ==========================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.rows import named

#: For tests only: give a secret of your own to `pseudonymise`.
DEFAULT_KEY = "orrery"
ROUNDS = 8
#: Days of the 400 years from 1800 on; the Gregorian calendar repeats after as many.
FIRST_DAY, DAY_FACTORS = "1800-01-01", (189, 773)

_EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}"
    r"@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63}){1,8}"
)
_START = r"(?<![A-Za-z0-9])"
_END = r"(?![A-Za-z0-9])"
_IBAN = _START + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END
_DATE = (
    r"(?<![A-Za-z0-9.-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}"
    r"|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})" + r"(?![A-Za-z0-9]|[.-][0-9])"
)
_IP = r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])"
_SSN = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9]|-[0-9])"
_CARD = _START + r"(?<!\+)[0-9](?:[ -]?[0-9]){12,18}" + _END
_PHONE = (
    r"(?:(?<![A-Za-z0-9+])(?:\+1[ .-]?|1[ .-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
    r"|(?<![A-Za-z0-9])\+[0-9](?:[ .-]?[()]?[ .-]?[0-9]){6,14}"
    r"|(?<![A-Za-z0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
    r"|(?<![A-Za-z0-9+-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})" + _END
)
FOUND = "|".join([_EMAIL, _IBAN, _DATE, _IP, _SSN, _CARD, _PHONE])
#: A candidate behind one character of context, anywhere and at the very start.
_NEXT, _HERE = r"(?<=[\s\S])(?:" + FOUND + ")", r"(?<=^[\s\S])(?:" + FOUND + ")$"
_LONG = r"(?<=^[\s\S])(?:" + _CARD + "|" + _PHONE + ")"
#: Tokens that candidates can be made of, over the blanks that candidates can hold; no
#: candidate reaches over the end of such a stretch, and none starts without a digit or at sign.
ZONE = r"(?<!\S)\S*[0-9@]\S*(?: {1,2}(?:\S*[0-9@]\S*|[A-Z]{1,4}(?![A-Za-z0-9])\S*|[().-]{1,3}(?=\s|$)))*+"
#: A stretch is read in blocks of so many characters, each with what the one before left
#: undecided: as much as the longest address, or the longest other item, and its context.
BLOCK, REACH_ADDRESS, REACH = 512, 704, 72
#: Country codes of telephone numbers; all others have three digits. Fixed values, ITU-T E.164.
COUNTRY = "1|7|2[07]|3[0123469]|4[013456789]|5[12345678]|6[0123456]|8[1246]|9[0123458]|[0-9]{3}"
KINDS = ("email", "iban", "date", "ip", "ssn", "card", "phone")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(a: str, b: str, modulus_a: str, modulus_b: str, tweak: str, key: str) -> str:
    """SQL for the pair (a, b) permuted within [0, modulus_a) x [0, modulus_b)."""

    def drawn(i: str, half: str) -> str:
        told = f"concat_ws('|', {key}, {tweak}, {i}, {half})"
        return f"cast(conv(substr(sha2({told}, 256), 1, 15), 16, 10) as bigint)"

    return f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)),
        (s, i) -> if(i % 2 = 1,
            named_struct('a', pmod(s.a + {drawn('i', 's.b')}, {modulus_a}), 'b', s.b),
            named_struct('a', s.a, 'b', pmod(s.b + {drawn('i', 's.a')}, {modulus_b}))))"""


def _digits(text: str, tweak: str, key: str, radix: int = 10) -> str:
    """SQL for a string of digits (of up to 36, or 22 in radix 36) permuted in its length."""

    def number(part: str) -> str:
        return f"cast(conv({part}, {radix}, 10) as bigint)" if radix != 10 else f"cast({part} as bigint)"

    def spelt(n: str, width: str) -> str:
        shown = f"lower(conv(cast({n} as string), 10, {radix}))" if radix != 10 else f"cast({n} as string)"
        return f"lpad({shown}, {width}, '0')"

    powers = ", ".join(f"{radix**i}L" for i in range(1, 19 if radix == 10 else 12))
    power = f"element_at(array({powers}), {{}})".format
    half, rest = "length(x) div 2", "length(x) - length(x) div 2"
    mixed = _feistel(
        number(f"substr(x, 1, cast({half} as int))"),
        number(f"substr(x, cast({half} as int) + 1)"),
        power(f"cast({half} as int)"),
        power(f"cast({rest} as int)"),
        f"concat({tweak}, length(x))",
        key,
    )
    # a let-binding is an array of one value; a single digit is shifted by the key alone
    return f"""element_at(transform(array({text}), x -> if(length(x) < 2,
        {spelt(f"pmod({number('x')} + cast(conv(substr(sha2(concat_ws('|', {key}, {tweak}), 256), 1, 8), 16, 10) as bigint), {radix})", "length(x)")},
        element_at(transform(array({mixed}), p -> concat(
            {spelt('p.a', f"cast({half} as int)")}, {spelt('p.b', f"cast({rest} as int)")})), 1))), 1)"""


def _filled(form: str, digits: str, kind: str = "[0-9]") -> str:
    """SQL for `form` with its characters of `kind` replaced by `digits`, one after another."""
    return f"""element_at(transform(array(named_struct('f', {form}, 'd', {digits})), v ->
        aggregate(sequence(1, length(v.f)), named_struct('t', '', 'k', 1),
            (s, i) -> if(substr(v.f, i, 1) rlike '{kind}',
                named_struct('t', concat(s.t, substr(v.d, s.k, 1)), 'k', s.k + 1),
                named_struct('t', concat(s.t, substr(v.f, i, 1)), 'k', s.k)),
            s -> s.t)), 1)"""


def _luhn(digits: str) -> str:
    """SQL for the Luhn sum of a string of digits, the last counted once."""
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + element_at(
        if(i % 2 = 1, array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9), array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)),
        1 + cast(substr({digits}, length({digits}) + 1 - i, 1) as int)))"""


def _mod97(text: str) -> str:
    """SQL for the remainder by 97 of digits and capital letters, the letters as 10 to 35."""
    return f"""aggregate(sequence(1, length({text})), 0, (s, i) ->
        if(substr({text}, i, 1) rlike '[0-9]', (s * 10 + cast(substr({text}, i, 1) as int)) % 97,
           (s * 100 + ascii(substr({text}, i, 1)) - 55) % 97))"""


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def kind_of(m: str) -> str:
    """SQL for the kind of a match that is valid, else null."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    plain = f"regexp_replace({m}, ' ', '')"
    full = lambda pattern: _quoted(f"^(?:{pattern})$")
    area = f"substr({m}, 1, 3)"
    return f"""case
        when {m} like '%@%' then 'email'
        when {m} rlike '^[A-Z]{{2}}' then
            if(length({plain}) between 15 and 34 and
               {_mod97(f"concat(substr({plain}, 5), substr({plain}, 1, 4))")} = 1, 'iban', null)
        when {m} rlike {full(_DATE)} then if(year({_day(m)}) between 1800 and 2199, 'date', null)
        when {m} rlike {full(_IP)} then
            if(forall(split({m}, '[.]'), o -> cast(o as int) <= 255), 'ip', null)
        when {m} rlike {full(_SSN)} then
            if({area} not in ('000', '666') and {area} < '900' and substr({m}, 5, 2) <> '00'
               and substr({m}, 8) <> '0000', 'ssn', null)
        when {m} rlike {full(_CARD)} and {_luhn(digits)} % 10 = 0 then 'card'
        when {m} rlike {full(_PHONE)} then
            if(length({digits}) between 7 and 15, 'phone', null)
        end"""


def _fields(m: str) -> str:
    return f"split({m}, '[-/.]')"


def _day(m: str) -> str:
    """SQL for the day a date names: year first; else day first unless only month first is right."""
    at = lambda i: f"cast(element_at({_fields(m)}, {i}) as int)"
    made = lambda y, mo, d: (
        f"try_to_date(concat_ws('-', lpad({y}, 4, '0'), lpad({mo}, 2, '0'), lpad({d}, 2, '0')), 'yyyy-MM-dd')"
    )
    return f"""if({m} rlike '^[0-9]{{4}}', {made(at(1), at(2), at(3))},
        coalesce({made(at(3), at(2), at(1))}, {made(at(3), at(1), at(2))}))"""


def _new_date(m: str, key: str) -> str:
    a, b = DAY_FACTORS
    number = f"datediff({_day(m)}, date '{FIRST_DAY}')"
    mixed = _let(
        _let(number, "n", _feistel(f"n div {b}", f"n % {b}", str(a), str(b), "'date'", key)),
        "p",
        f"date_add(date '{FIRST_DAY}', cast(p.a * {b} + p.b as int))",
    )
    first, second = f"substr({m}, 5, 1)", f"regexp_extract({m}, '[-/.]', 0)"
    at = lambda i: f"cast(element_at({_fields(m)}, {i}) as int)"
    day_first = f"try_to_date(concat_ws('-', lpad({at(3)}, 4, '0'), lpad({at(2)}, 2, '0'), lpad({at(1)}, 2, '0')), 'yyyy-MM-dd') is not null"
    y, mo, d = ("lpad(year(t), 4, '0')", "lpad(month(t), 2, '0')", "lpad(day(t), 2, '0')")
    return _let(
        mixed,
        "t",
        f"""case when {m} rlike '^[0-9]{{4}}' then concat_ws({first}, {y}, {mo}, {d})
            when {day_first} then concat_ws({second}, {d}, {mo}, {y})
            else concat_ws({second}, {mo}, {d}, {y}) end""",
    )


def _new_ip(m: str, key: str) -> str:
    at = lambda i: f"cast(element_at(split({m}, '[.]'), {i}) as int)"
    mixed = _feistel(
        f"{at(1)} * 256 + {at(2)}", f"{at(3)} * 256 + {at(4)}", "65536", "65536", "'ip'", key
    )
    return _let(
        mixed, "p", "concat_ws('.', p.a div 256, p.a % 256, p.b div 256, p.b % 256)"
    )


def _new_card(m: str, key: str) -> str:
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    body = _digits(f"substr({digits}, 1, length({digits}) - 1)", "'card'", key)
    whole = _let(body, "c", f"concat(c, (10 - {_luhn("concat(c, '0')")} % 10) % 10)")
    return _filled(m, whole)


def _new_iban(m: str, key: str) -> str:
    plain = f"regexp_replace({m}, ' ', '')"
    number = f"regexp_replace(substr({plain}, 5), '[^0-9]', '')"
    body = _filled(f"substr({plain}, 5)", _digits(number, "'iban'", key))
    country = f"substr({m}, 1, 2)"
    checked = _let(
        body,
        "c",
        f"concat({country}, lpad(98 - {_mod97(f"concat(c, {country}, '00')")}, 2, '0'), c)",
    )
    return _filled(m, checked, "[A-Z0-9]")


def _new_phone(m: str, key: str) -> str:
    """The national digits are permuted, so that all spellings of a number stay linked.

    The country code is kept, and is 1 where a number is written in 3-3-4 form alone;
    so is a trunk prefix in brackets, as in "+44 (0)20".
    """
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    code = f"if({m} rlike '^[+1]' and length({digits}) <> 10 or {m} like '+%', regexp_extract({digits}, '^({COUNTRY})', 1), '')"
    trunk = f"if({m} rlike '^[+][0-9 .-]{{1,6}}[(]0[)]' and substr(n.d, length(n.c) + 1, 1) = '0', '0', '')"
    national = "substr(n.d, length(n.c) + length(n.t) + 1)"
    country = "if(n.c = '', '1', n.c)"
    new = f"concat(n.c, n.t, {_digits(national, f"concat('phone', {country})", key)})"
    parts = _let(
        f"named_struct('d', {digits}, 'c', {code})", "n", f"named_struct('d', n.d, 'c', n.c, 't', {trunk})"
    )
    return _filled(m, _let(parts, "n", new))


def _new_ssn(m: str, key: str) -> str:
    # area 1 to 665, group 1 to 99 and serial 1 to 9999 are numbers without a reserved one
    part = lambda at, n: f"cast(substr({m}, {at}, {n}) as int) - 1"
    area = f"if(substr({m}, 1, 3) > '666', {part(1, 3)} - 1, {part(1, 3)})"
    mixed = _feistel(f"({area}) * 99 + {part(5, 2)}", part(8, 4), "88802", "9999", "'ssn'", key)
    return _let(
        mixed,
        "p",
        """concat_ws('-', lpad(if(p.a div 99 >= 665, p.a div 99 + 2, p.a div 99 + 1), 3, '0'),
            lpad(p.a % 99 + 1, 2, '0'), lpad(p.b + 1, 4, '0'))""",
    )


def _new_email(m: str, key: str) -> str:
    local, host = f"lower(substring_index({m}, '@', 1))", f"substring_index({m}, '@', -1)"
    signs = f"regexp_replace({local}, '[^a-z0-9]', '')"
    # 22 signs at a time, so that a half stays below 2^63
    parts = f"transform(sequence(0, (length(y) - 1) div 22), j -> {_digits('substr(y, j * 22 + 1, 22)', "concat('email', j)", key, 36)})"
    return f"concat({_filled(local, _let(signs, 'y', f"array_join({parts}, '')"), '[a-z0-9]')}, '@', {host})"


def replacement(m: str, key: str) -> str:
    """SQL for the pseudonym of the match `m.x` of the kind `m.k`; null without a kind."""
    kind, m = f"{m}.k", f"{m}.x"
    new = {
        "email": _new_email(m, key),
        "iban": _new_iban(m, key),
        "date": _new_date(m, key),
        "ip": _new_ip(m, key),
        "ssn": _new_ssn(m, key),
        "card": _new_card(m, key),
        "phone": _new_phone(m, key),
    }
    cases = " ".join(f"when '{name}' then {new[name]}" for name in KINDS)
    return f"case {kind} {cases} end"


def _shorter(x: str) -> str:
    """SQL for the prefixes of `x` that end before a separator, the longest first."""
    return f"""transform(filter(reverse(sequence(1, greatest(length({x}), 1))), e ->
        substr({x}, e, 2) rlike '^[A-Za-z0-9][^A-Za-z0-9]$'), e -> substr({x}, 1, e))"""


def _pieces(zone: str) -> str:
    """SQL for the array of (k, x) that make up a stretch of text; k is null for plain text.

    The stretch is read block by block, so a step handles text of bounded length however
    long the stretch is. The state `r` is what is left of a block, behind one character
    of context, `d` tells that the block is done, `o` and the plain text `g` behind it are
    the block's pieces. A step takes the next candidate. Not valid in any prefix, only its
    first run of letters and digits is passed over. A candidate that starts among the last
    characters of a block may reach into the next one and waits for it.
    """
    plain = lambda text: f"named_struct('k', cast(null as string), 'x', {text})"
    follows = "substr(concat(c.x, c.a), length(p) + 1, 2)"
    # a shorter prefix has to stand in its context as its pattern asks
    fits = f"""p = c.x or (concat(c.p, p) rlike {_quoted(_HERE)} and not
        case q.k when 'ssn' then {follows} rlike '^-[0-9]' when 'ip' then {follows} rlike '^[.][0-9]'
            when 'date' then {follows} rlike '^[.-][0-9]' else false end)"""
    tried = f"""concat(array(c.x), {_shorter('c.x')}, array(c.y), {_shorter('c.y')})"""
    kinds = f"""filter(transform(filter({tried}, p -> p = c.x or concat(c.p, p) rlike {_quoted(_HERE)}),
        p -> {_let(f"named_struct('k', {kind_of('p')}, 'x', p)", 'q', f"if({fits}, q, {plain('p')})")}),
        q -> q.k is not null)"""
    passed = "regexp_extract(c.x, '^(?:[A-Za-z0-9]+|[^A-Za-z0-9])', 0)"
    on = lambda x: f"concat(right({x}, 1), substr(concat(c.x, c.a), length({x}) + 1))"
    state = lambda o, g, r, d: f"named_struct('o', {o}, 'g', {g}, 'r', {r}, 'd', {d})"
    before = "concat(s.g, substr(c.b, 2))"
    taken = _let(
        kinds,
        "found",
        f"""if(size(found) > 0,
            {_let('found[0]', 'f', state(f"concat(s.o, array({plain(before)}, f))", "''", on('f.x'), 'false'))},
            {_let(passed, 'd', state('s.o', f'concat({before}, d)', on('d'), 'false'))})""",
    )
    candidate = f"""named_struct('b', h[0], 'p', right(h[0], 1), 'a', h[1],
        'x', regexp_extract(s.r, {_quoted(_NEXT)}, 0))"""
    longer = f"regexp_extract(concat(b.p, b.x, b.a), {_quoted(_LONG)}, 0)"
    # the end of the stretch decides all; before it, the last characters wait
    settled = "if(t.z, length(s.r), greatest(length(s.r) - w, 0))"
    rest = state(
        "s.o",
        f"concat(s.g, substr(s.r, 2, if(t.z, length(s.r), {settled})))",
        f"if(t.z, '', substr(s.r, {settled} + 1))",
        "true",
    )
    step = _let(
        f"split(s.r, {_quoted(_NEXT)}, 2)",
        "h",
        f"""if(size(h) < 2 or length(h[0]) > {settled}, {rest},
            {_let(_let(candidate, 'b', f"named_struct('b', b.b, 'p', b.p, 'a', b.a, 'x', b.x, 'y', {longer})"), 'c', taken)})""",
    )
    # each step but the last passes over a run of letters and digits or one of these signs
    steps = "sequence(1, 1 + size(regexp_extract_all(s.r, '[A-Za-z0-9]+|[^A-Za-z0-9]', 0)))"
    none = "cast(array() as array<struct<k:string,x:string>>)"
    block = f"aggregate({steps}, s, (s, i) -> if(s.d, s, {step}))"
    fed = _let(state(none, "''", "concat(u.r, t.x)", "false"), "s", block)
    joined = _let(
        fed, "s", f"named_struct('o', concat(u.o, s.o, array({plain('s.g')})), 'r', s.r)"
    )
    blocks = f"regexp_extract_all({zone}, '[\\\\s\\\\S]{{1,{BLOCK}}}', 0)"
    marked = f"transform(e, (x, j) -> named_struct('x', x, 'z', j = size(e) - 1))"
    read = f"""aggregate({_let(blocks, 'e', marked)},
        named_struct('o', {none}, 'r', '\n'), (u, t) -> {joined}, u -> u.o)"""
    reach = f"if({zone} like '%@%', {REACH_ADDRESS}, {REACH})"
    return f"if({zone} rlike {_quoted(FOUND)}, {_let(reach, 'w', read)}, array({plain(zone)}))"


def pseudonymise(
    docs: DataFrame, *, text: str = "text", key: str = DEFAULT_KEY
) -> DataFrame:
    """`docs` with the two columns `pseudonymised` and `n_pii` put after its own.

    `pseudonymised` is the text with every valid item replaced, `n_pii` how many
    there were. A null text stays null with no items, an empty one empty. Every row
    is handled by itself: repeated rows give the same, and the other columns are
    not looked at. A caller whose table has columns of these names takes the last
    two by position.
    """
    secret = _quoted(key)
    zone = _quoted(ZONE)
    replaced = replacement("w", secret)
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = named(docs, text)
    rows = docs.select(*[named(docs, c).alias(n) for c, n in zip(docs.columns, names)], body.alias("t"))
    # texts without a digit or an at sign hold none, and are not searched further
    rows = rows.withColumn(
        "m", F.expr(f"if(t rlike '[0-9@]', regexp_extract_all(t, {zone}, 0), array())")
    )
    plain = "named_struct('k', cast(null as string), 'x', g)"
    made = f"""flatten(transform(split(t, {zone}, -1), (g, h) ->
        if(h < size(m), concat(array({plain}), {_let("m[h]", "z", _pieces("z"))}), array({plain}))))"""
    rows = rows.withColumn("v", F.expr(f"if(size(m) > 0, {made}, array())")).withColumn(
        "n", F.expr("cast(coalesce(size(filter(v, x -> x.k is not null)), 0) as bigint)")
    )
    joined = f"array_join(transform(v, w -> coalesce({replaced}, w.x)), '')"
    return rows.select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names)],
        F.expr(f"if(n > 0, {joined}, t)").alias("pseudonymised"),
        F.expr("if(t is null, 0L, n)").alias("n_pii"),
    )
