"""Scalar rules as SQL expressions, for Spark and, by the dialect ``d``, for DuckDB.

Every function takes SQL operands (strings) and returns an expression;
``palimpsest.functions.columns`` wraps them as Columns. The registry's oracle uses
none of them: its SQL is written apart.
"""

from __future__ import annotations

import itertools

SPARK, DUCK = "spark", "duckdb"

#: Weights of the tax-id check digits.
INN10 = [2, 4, 10, 3, 5, 9, 4, 6, 8]
INN12_A = [7, 2, 4, 10, 3, 5, 9, 4, 6, 8]
INN12_B = [3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8]
#: Widest number that a BIGINT permutation holds, and that one of two DECIMAL halves holds.
MAX_DIGITS, MAX_WIDE = 18, 38
#: Fixed value: letters of base 32.
BASE32 = "abcdefghijklmnopqrstuvwxyz234567"


class Operand(str):
    """SQL that yields the secret, such as a column's name; the secret itself then stands in no plan."""


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret(salt: str) -> str:
    return salt if isinstance(salt, Operand) else lit(salt)


_names = itertools.count()


def let(d: str, x: str, body) -> str:
    """body(name) with x computed once and bound to the name."""
    v = f"v{next(_names)}"
    if d == SPARK:
        return f"element_at(transform(array({x}), {v} -> {body(v)}), 1)"
    return f"list_extract(list_transform(list_value({x}), lambda {v}: {body(v)}), 1)"


def text(x: str) -> str:
    return f"cast({x} as string)"


def h60(d: str, salt: str, *parts: str) -> str:
    """Keyed 60-bit hash of the parts."""
    joined = f"concat_ws('|', {secret(salt)}, {', '.join(text(p) for p in parts)})"
    if d == SPARK:
        return f"cast(conv(substr(sha2({joined}, 256), 1, 15), 16, 10) as bigint)"
    return f"cast('0x' || substr(sha256({joined}), 1, 15) as bigint)"


def sub(d: str, x: str, pattern: str, to: str) -> str:
    """Replaces every match of a pattern."""
    if d == SPARK:
        return f"regexp_replace({x}, r{lit(pattern)}, {lit(to)})"
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to.replace('$', chr(92)))}, 'g')"


def matches(d: str, x: str, pattern: str) -> str:
    return f"({x} rlike r{lit(pattern)})" if d == SPARK else f"regexp_matches({x}, {lit(pattern)})"


def pick_int(d: str, salt: str, low: int, high: int, *key: str) -> str:
    return f"({low} + {h60(d, salt, *key)} % {high - low + 1})"


def base32(d: str, salt: str, n: int, *key: str) -> str:
    """n characters of the hash, five bits each, lowest first; 12 are all it has."""
    h = h60(d, salt, *key)
    return "concat(" + ", ".join(f"substr('{BASE32}', cast(({h} // {32**i}) % 32 as int) + 1, 1)" if d == DUCK else f"substr('{BASE32}', cast(({h} div {32**i}) % 32 as int) + 1, 1)" for i in range(n)) + ")"


# -- identity keys


def norm_word(d: str, x: str) -> str:
    return f"replace(lower(trim({x})), 'ё', 'е')"


def digits(d: str, x: str) -> str:
    return sub(d, x, "[^0-9]", "")


def norm_phone(d: str, x: str) -> str:
    n = digits(d, x)
    return f"case when length({n}) = 11 and substr({n}, 1, 1) in ('7', '8') then concat('+7', substr({n}, 2)) when length({n}) = 10 then concat('+7', {n}) else concat('+', {n}) end"


def norm_email(d: str, x: str) -> str:
    return sub(d, f"lower(trim({x}))", r"\+[^@]*@", "@")


def norm_address(d: str, x: str) -> str:
    return sub(d, norm_word(d, x), r"\s+", " ")


# -- permutations of digits


def fpe(d: str, salt: str, label: str, x: str, n: int) -> str:
    """Bijection on [0, 10^n): four Feistel rounds with modular addition."""
    if n == 1:
        return f"(({x} + {h60(d, salt, lit(label), '0')} % 10) % 10)"
    a, b = 10 ** (n // 2), 10 ** (n - n // 2)
    div = "div" if d == SPARK else "//"

    def rounds(left: str, right: str, i: int) -> str:
        if i == 4:
            return f"({left} * {b} + {right})"
        size = b if i % 2 else a
        return let(d, f"(({left} + {h60(d, salt, lit(label), str(i), right)}) % {size})", lambda new: rounds(right, new, i + 1))

    return let(d, x, lambda v: let(d, f"({v} {div} {b})", lambda left: let(d, f"({v} % {b})", lambda right: rounds(left, right, 0))))


def big(x: str) -> str:
    return f"try_cast({x} as bigint)"


def padded(x: str, n: int) -> str:
    return f"lpad(cast({x} as string), {n}, '0')"


def _weighted(s: str, weights: list[int]) -> str:
    return "(" + " + ".join(f"{w} * try_cast(substr({s}, {i + 1}, 1) as int)" for i, w in enumerate(weights)) + ")"


def inn_check(s: str, weights: list[int]) -> str:
    return f"({_weighted(s, weights)} % 11 % 10)"


def snils_check(s: str) -> str:
    return f"({_weighted(s, list(range(9, 0, -1)))} % 101 % 100)"


def valid_inn(d: str, x: str) -> str:
    last = lambda k: f"try_cast(substr({x}, {k}, 1) as int)"
    return (
        f"coalesce(case when {matches(d, x, '^[0-9]{10}$')} then {inn_check(x, INN10)} = {last(10)}"
        f" when {matches(d, x, '^[0-9]{12}$')} then {inn_check(x, INN12_A)} = {last(11)} and {inn_check(x, INN12_B)} = {last(12)} else false end, false)"
    )


def valid_snils(d: str, x: str) -> str:
    return f"coalesce({matches(d, x, '^[0-9]{11}$')} and {snils_check(x)} = try_cast(substr({x}, 10, 2) as int), false)"


def valid_ogrn(d: str, x: str) -> str:
    return (
        f"coalesce(case when {matches(d, x, '^[0-9]{13}$')} then {big(f'substr({x}, 1, 12)')} % 11 % 10 = try_cast(substr({x}, 13, 1) as int)"
        f" when {matches(d, x, '^[0-9]{15}$')} then {big(f'substr({x}, 1, 14)')} % 13 % 10 = try_cast(substr({x}, 15, 1) as int) else false end, false)"
    )


def gen_inn10(d: str, salt: str, x: str) -> str:
    body = padded(fpe(d, salt, "inn10", big(f"substr({x}, 1, 9)"), 9), 9)
    return let(d, body, lambda b: f"concat({b}, cast({inn_check(b, INN10)} as string))")


def gen_inn12(d: str, salt: str, x: str) -> str:
    body = padded(fpe(d, salt, "inn12", big(f"substr({x}, 1, 10)"), 10), 10)
    eleven = let(d, body, lambda b: f"concat({b}, cast({inn_check(b, INN12_A)} as string))")
    return let(d, eleven, lambda e: f"concat({e}, cast({inn_check(e, INN12_B)} as string))")


def gen_snils(d: str, salt: str, x: str) -> str:
    body = padded(fpe(d, salt, "snils", big(f"substr({x}, 1, 9)"), 9), 9)
    return let(d, body, lambda b: f"concat({b}, {padded(snils_check(b), 2)})")


def gen_ogrn(d: str, salt: str, x: str, sole: bool = False) -> str:
    n, m, label = (14, 13, "ogrnip") if sole else (12, 11, "ogrn")
    body = fpe(d, salt, label, big(f"substr({x}, 1, {n})"), n)
    return let(d, body, lambda b: f"concat({padded(b, n)}, cast({b} % {m} % 10 as string))")


# -- permutations of any width, in Spark


def fpe_text(salt: str, label: str, x: str) -> str:
    """The digit string x permuted among those of its width: ``fpe`` with the width found per value, up to MAX_WIDE digits; more raise.
    label: SQL of the label."""

    def rounds(kind: str, s: str, n: str) -> str:
        power = lambda k: f"cast(rpad('1', {k} + 1, '0') as {kind})"

        def step(left: str, right: str, i: int) -> str:
            if i == 4:
                return f"concat(lpad(cast({left} as string), {n} div 2, '0'), lpad(cast({right} as string), {n} - {n} div 2, '0'))"
            size = power(f"{n} - {n} div 2" if i % 2 else f"{n} div 2")
            return let(SPARK, f"cast(({left} + {h60(SPARK, salt, label, str(i), right)}) % {size} as {kind})", lambda new: step(right, new, i + 1))

        halves = f"cast(substr({s}, 1, {n} div 2) as {kind})", f"cast(substr({s}, {n} div 2 + 1) as {kind})"
        return let(SPARK, halves[0], lambda left: let(SPARK, halves[1], lambda right: step(left, right, 0)))

    def body(s: str) -> str:
        n = f"length({s})"
        one = f"cast((cast({s} as bigint) + {h60(SPARK, salt, label, '0')} % 10) % 10 as string)"
        wide = f"raise_error('a number of more than {MAX_WIDE} digits')"
        return f"case when {n} = 1 then {one} when {n} <= {MAX_DIGITS} then {rounds('bigint', s, n)} when {n} <= {MAX_WIDE} then {rounds('decimal(20,0)', s, n)} else cast({wide} as string) end"

    return let(SPARK, x, body)


def lay(x: str, new: str) -> str:
    """The digits ``new`` in the places of the digits of x, as many; everything else stays."""
    at = lambda i: f"length(regexp_replace(substr({x}, 1, {i} + 1), '[^0-9]', ''))"
    return f"array_join(transform(split({x}, ''), (ch, i) -> case when ch rlike '^[0-9]$' then substr({new}, {at('i')}, 1) else ch end), '')"


def digits_like(salt: str, x: str) -> str:
    """gen_digits for all widths; a text without digits stays."""
    label = lambda n: f"concat('digits', length({n}))"
    return let(SPARK, x, lambda v: let(SPARK, digits(SPARK, v), lambda n: f"case when {n} = '' then {v} else {let(SPARK, fpe_text(salt, label(n), n), lambda new: lay(v, new))} end"))


#: Steps of the walk: a tenth of the numbers needs another one each time.
WALK = 40


def int_like(salt: str, x: str) -> str:
    """A number of as many digits, without a leading zero: the permutation is walked until one comes. One to one.
    Anything but digits, a leading zero or an unsettled walk raises, without the value."""
    label = lambda n: f"concat('int', length({n}))"
    bad = "cast(raise_error('gen_int_like: not a whole number without a leading zero') as string)"
    left = "cast(raise_error('gen_int_like: unsettled') as string)"

    def walk(v: str) -> str:
        step = lambda s: fpe_text(salt, label(s), s)
        last = f"aggregate(sequence(1, {WALK}), {step(v)}, (w, i) -> case when w like '0%' then {step('w')} else w end)"
        return let(SPARK, last, lambda w: f"case when {w} like '0%' and length({w}) > 1 then {left} else {w} end")

    def body(v: str) -> str:
        return f"case when {v} is null then null when not ({v} rlike '^[0-9]+$') or (length({v}) > 1 and {v} like '0%') then {bad} when length({v}) = 1 then {fpe_text(salt, label(v), v)} else {walk(v)} end"

    return let(SPARK, x, body)


def luhn_like(salt: str, x: str) -> str:
    """The digits of x with all but the last permuted, and a valid Luhn digit; no digits: x. A single digit raises."""
    double = "case when i % 2 = 1 then 2 * cast(substr(b, length(b) - i + 1, 1) as int) - case when substr(b, length(b) - i + 1, 1) > '4' then 9 else 0 end else cast(substr(b, length(b) - i + 1, 1) as int) end"
    check = "cast((10 - aggregate(transform(sequence(1, length(b)), i -> DOUBLE), 0, (a, t) -> a + t) % 10) % 10 as string)".replace("DOUBLE", double)

    def body(n: str) -> str:
        made = f"element_at(transform(array({fpe_text(salt, lit('luhn'), f'substr({n}, 1, length({n}) - 1)')}), b -> concat(b, {check})), 1)"
        return f"case when {n} = '' then {x} when length({n}) = 1 then cast(raise_error('gen_luhn_like: a single digit') as string) else {made} end"

    return let(SPARK, digits(SPARK, x), body)


# -- corpora


def pick(d: str, salt: str, label: str, corpus: list[str], key: str, avoid: str | None = None) -> str:
    """An entry of a corpus without duplicates, by the key's hash; the next one if it would be the source value itself."""
    n = len(corpus)
    at = f"cast({h60(d, salt, lit(label), key)} % {n} as int)"
    array = ("array(" if d == SPARK else "list_value(") + ", ".join(lit(c) for c in corpus) + ")"
    get = lambda i: f"element_at({array}, {i} + 1)" if d == SPARK else f"list_extract({array}, {i} + 1)"
    if avoid is None:
        return get(at)
    return f"case when {norm_word(d, get(at))} = {norm_word(d, avoid)} then {get(f'(({at} + 1) % {n})')} else {get(at)} end"


def title(x: str) -> str:
    return f"concat(upper(substr({x}, 1, 1)), lower(substr({x}, 2)))"


def fake_phone(d: str, salt: str, codes: list[str], x: str) -> str:
    """A code of the corpus and seven hashed digits; the next number if that is the source's own."""
    key = norm_phone(d, x)
    code, tail = pick(d, salt, "phone_code", codes, key), pick_int(d, salt, 0, 9_999_999, lit("phone"), key)
    number = lambda t: f"concat('+7', {code}, {padded(t, 7)})"
    return let(d, tail, lambda t: f"case when {number(t)} = {key} then {number(f'(({t} + 1) % 10000000)')} else {number(t)} end")


def fake_email(d: str, salt: str, names: list[str], domains: list[str], x: str) -> str:
    key = norm_email(d, x)
    return f"concat({pick(d, salt, 'family', names, key)}, '.', {base32(d, salt, 12, lit('email'), key)}, '@', {pick(d, salt, 'email_domain', domains, key)})"


def fake_address(d: str, salt: str, regions: list[str], cities: list[str], streets: list[str], x: str) -> str:
    key = norm_address(d, x)
    part = lambda label, corpus: title(pick(d, salt, label, corpus, key))
    return (
        f"concat({part('region', regions)}, ', г. ', {part('city', cities)}, ', ул. ', {part('street', streets)}, ', д. ', "
        f"cast({pick_int(d, salt, 1, 99, lit('house'), key)} as string), ', кв. ', cast({pick_int(d, salt, 1, 250, lit('flat'), key)} as string))"
    )
