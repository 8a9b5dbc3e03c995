"""The scalar rules as Spark Columns: what the plan compiler and users call."""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sqlgen as g
from .sqlgen import SPARK

#: Letters of the transliteration.
TRANSLIT = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
#: Endings that tell the gender, and feminine endings with their masculine form.
FEMALE_PATRONYMIC, MALE_PATRONYMIC = "(вна|чна|шна)$", "(вич|ьич|мич)$"
FEMALE_FAMILY = "(ова|ева|ина|ына|ская|цкая|ая)$"
FAMILY_ENDINGS = [("ская", "ский"), ("цкая", "цкий"), ("ова", "ов"), ("ева", "ев"), ("ина", "ин"), ("ына", "ын")]


def quoted(name: str) -> str:
    """A column's name in SQL, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def effective_salt(master: str, version: str = "1", recipient: str = "dev", generation: str = "g1") -> str:
    """The salt of one recipient and generation; computed once, on the driver."""
    if not master:
        raise ValueError("a master salt is needed; there is no default")
    return hmac.new(master.encode(), "\0".join((version, recipient, generation)).encode(), hashlib.sha256).hexdigest()


def salt_fingerprint(salt: str) -> str:
    return hashlib.sha256(b"fp\0" + salt.encode()).hexdigest()[:16]


def h60(salt: str, *parts: str) -> Column:
    return F.expr(g.h60(SPARK, salt, *parts))


def bind_secret(df: DataFrame, salt: str) -> tuple[DataFrame, g.Operand]:
    """The frame with the secret as column ``_secret`` and the operand that names it: functions that take the operand for
    their salt leave the secret out of plans, logs and event files. One row is broadcast; drop the column in the end."""
    one = df.sparkSession.createDataFrame([(salt,)], "_secret string")
    return df.crossJoin(F.broadcast(one)), g.Operand("`_secret`")


def h60_value(salt: str, *parts: str) -> int:
    """Twin of h60 in Python."""
    return int(hashlib.sha256("|".join((salt, *parts)).encode()).hexdigest()[:15], 16)


def fpe_value(salt: str, label: str, x: int, n: int) -> int:
    """Twin of fpe in Python, for any number of digits."""
    if n == 1:
        return (x + h60_value(salt, label, "0") % 10) % 10
    a, b = 10 ** (n // 2), 10 ** (n - n // 2)
    left, right, size = x // b, x % b, a
    for i in range(4):
        left, right = right, (left + h60_value(salt, label, str(i), str(right))) % size
        size = b if size == a else a
    return left * b + right


def fpe(salt: str, label: str, x: str, n: int) -> Column:
    if not 1 <= n <= g.MAX_DIGITS:
        raise ValueError(f"{n} digits don't fit a BIGINT permutation")
    return F.expr(g.fpe(SPARK, salt, label, x, n))


def pick_int(salt: str, low: int, high: int, *key: str) -> Column:
    return F.expr(g.pick_int(SPARK, salt, low, high, *key))


def translit(x: Column) -> Column:
    """Cyrillic to Latin letter by letter, case lowered; other characters stay."""
    table = F.create_map(*[F.lit(v) for pair in TRANSLIT.items() for v in pair])
    return F.array_join(F.transform(F.split(F.lower(x), ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")


def norm_word(x: str) -> Column:
    return F.expr(g.norm_word(SPARK, x))


def gender(family: Column, patronymic: Column) -> Column:
    """f or m: by the patronymic's ending, else by the surname's, else m. Null parts say nothing."""
    p, f = F.coalesce(patronymic, F.lit("")), F.coalesce(family, F.lit(""))
    return F.when(p.rlike(FEMALE_PATRONYMIC), "f").when(p.rlike(MALE_PATRONYMIC), "m").when(f.rlike(FEMALE_FAMILY), "f").otherwise("m")


def _swap_ending(x: Column, pairs: list[tuple[str, str]]) -> Column:
    out = None
    for old, new in pairs:
        hit, to = x.endswith(old), F.regexp_replace(x, f"{old}$", new)
        out = F.when(hit, to) if out is None else out.when(hit, to)
    return out.otherwise(x)


def masculine(family: Column) -> Column:
    return _swap_ending(family, FAMILY_ENDINGS)


def feminine(family: Column) -> Column:
    """Feminine form of a masculine surname; names that don't decline stay."""
    return _swap_ending(family, [(m, f) for f, m in FAMILY_ENDINGS])


def normalize_fio(family: str, name: str, patronymic: str) -> Column:
    """struct(family, name, patronymic, gender): lower case, the surname as masculine lemma."""
    fam, nam, pat = (F.expr(g.norm_word(SPARK, c)) for c in (family, name, patronymic))
    sex = gender(fam, pat)
    return F.struct(F.when(sex == "f", masculine(fam)).otherwise(fam).alias("family"), nam.alias("name"), pat.alias("patronymic"), sex.alias("gender"))


def normalize_phone(x: str) -> Column:
    return F.expr(g.norm_phone(SPARK, x))


def normalize_email(x: str) -> Column:
    return F.expr(g.norm_email(SPARK, x))


def normalize_digits(x: str) -> Column:
    return F.expr(g.digits(SPARK, x))


def normalize_address(x: str) -> Column:
    return F.expr(g.norm_address(SPARK, x))


def valid_inn(x: str) -> Column:
    return F.expr(g.valid_inn(SPARK, x))


def valid_snils(x: str) -> Column:
    return F.expr(g.valid_snils(SPARK, x))


def valid_ogrn(x: str) -> Column:
    return F.expr(g.valid_ogrn(SPARK, x))


def luhn_ok(x: str) -> Column:
    """13 to 19 digits with a right Luhn digit."""
    return F.coalesce(F.expr(g.matches(SPARK, x, "^[0-9]{13,19}$")) & F.expr(f"luhn_check({x})"), F.lit(False))


def gen_inn(salt: str, x: str) -> Column:
    """A valid tax id: of 12 digits if the source has more than 10, else of 10."""
    n = g.digits(SPARK, x)
    return F.when(F.length(F.expr(n)) > 10, F.expr(g.gen_inn12(SPARK, salt, n))).otherwise(F.expr(g.gen_inn10(SPARK, salt, n)))


def gen_snils(salt: str, x: str) -> Column:
    return F.expr(g.gen_snils(SPARK, salt, g.digits(SPARK, x)))


def gen_ogrn(salt: str, x: str) -> Column:
    n = g.digits(SPARK, x)
    return F.when(F.length(F.expr(n)) == 15, F.expr(g.gen_ogrn(SPARK, salt, n, True))).otherwise(F.expr(g.gen_ogrn(SPARK, salt, n)))


def gen_digits_like(salt: str, x: str) -> Column:
    """All digits of x permuted as one number of its width, everything else in place; over 38 digits raise."""
    return F.expr(g.digits_like(salt, x))


def gen_luhn_like(salt: str, x: str) -> Column:
    """A number of as many digits with a right Luhn digit; over 39 digits raise."""
    return F.expr(g.luhn_like(salt, x))


def gen_int_like(salt: str, x: str) -> Column:
    """A whole number of as many digits, one to one, as text; what is no whole number or has a leading zero raises."""
    return F.expr(g.int_like(salt, f"cast({x} as string)"))


def gen_int_like_value(salt: str, x: str) -> str:
    """Twin of gen_int_like in Python."""
    n = len(x)
    if not x.isdigit() or (n > 1 and x[0] == "0"):
        raise ValueError("gen_int_like: not a whole number without a leading zero")
    y = fpe_value(salt, f"int{n}", int(x), n)
    while n > 1 and y < 10 ** (n - 1):
        y = fpe_value(salt, f"int{n}", y, n)
    return str(y)


def gen_person_id(salt: str, x: str) -> Column:
    """One to one for a key: whole numbers stay whole numbers of their width, other texts keep all but their digits."""
    text = f"cast({x} as string)"
    return F.when(F.expr(f"{text} rlike '^[0-9]+$'"), gen_int_like(salt, x)).otherwise(gen_digits_like(salt, text))


def fake_passport(salt: str, series: str, number: str) -> tuple[Column, Column]:
    """Series and number of one document as one number of ten digits, as in free text; other widths each on its own."""
    a, b = (g.digits(SPARK, f"cast({x} as string)") for x in (series, number))
    whole = F.expr(f"length({a}) = 4 and length({b}) = 6")
    ten = g.fpe_text(salt, g.lit("digits10"), f"concat({a}, {b})")
    own = lambda x: gen_digits_like(salt, f"cast({x} as string)")
    return F.when(whole, F.expr(f"substr({ten}, 1, 4)")).otherwise(own(series)), F.when(whole, F.expr(f"substr({ten}, 5, 6)")).otherwise(own(number))


def title(x: Column) -> Column:
    """First letter of each word upper case; hyphens part no words."""
    return F.initcap(x)


def fake_phone(salt: str, corpora: dict, x: str) -> Column:
    return F.expr(g.fake_phone(SPARK, salt, corpora["phone_code"], x))


def fake_email(salt: str, corpora: dict, x: str) -> Column:
    latin = ["".join(TRANSLIT.get(c, c) for c in name) for name in corpora["family"]]
    return F.expr(g.fake_email(SPARK, salt, latin, corpora["email_domain"], x))


def fake_address(salt: str, corpora: dict, x: str) -> Column:
    return F.expr(g.fake_address(SPARK, salt, corpora["region"], corpora["city"], corpora["street"], x))


def fake_pick(salt: str, corpora: dict, corpus: str, x: str) -> Column:
    return F.expr(g.pick(SPARK, salt, corpus, corpora[corpus], g.norm_word(SPARK, x), x))


def fake_fio(salt: str, corpora: dict, family: str, name: str, patronymic: str) -> Column:
    """struct(family, name, patronymic): each part by its own key, the gender kept; null parts stay null."""
    fam, pat = (f"coalesce({g.norm_word(SPARK, x)}, '')" for x in (family, patronymic))
    female = f"case when {g.matches(SPARK, pat, FEMALE_PATRONYMIC)} then true when {g.matches(SPARK, pat, MALE_PATRONYMIC)} then false else {g.matches(SPARK, fam, FEMALE_FAMILY)} end"
    masc = g.norm_word(SPARK, family)
    for old, new in FAMILY_ENDINGS:
        masc = f"regexp_replace({masc}, '{old}$', '{new}')"
    # lemma and replacement are bound: each would otherwise be computed once an ending
    ending = lambda x: " ".join(f"when {x} like '%{m}' then regexp_replace({x}, '{m}$', '{f}')" for f, m in FAMILY_ENDINGS)
    new_family = g.let(SPARK, masc, lambda k: g.let(SPARK, g.pick(SPARK, salt, "family", corpora["family"], k, k), lambda x: f"case when not ({female}) then {x} {ending(x)} else {x} end"))
    by_sex = lambda part, column: F.when(F.expr(female), fake_pick(salt, corpora, f"{part}_f", column)).otherwise(fake_pick(salt, corpora, f"{part}_m", column))
    keep = lambda column, new: F.when(F.expr(column).isNotNull(), F.initcap(new))
    return F.struct(
        keep(family, F.expr(new_family)).alias("family"),
        keep(name, by_sex("name", name)).alias("name"),
        keep(patronymic, by_sex("patronymic", patronymic)).alias("patronymic"),
    )


def fake_fio_full(salt: str, corpora: dict, x: str) -> Column:
    """A name in one column, surname first: its words as surname, name and patronymic; more words go."""
    word = lambda i: f"try_element_at(filter(split(trim({x}), '[ \\t]+'), w -> w <> ''), {i})"
    new = fake_fio(salt, corpora, *(word(i) for i in (1, 2, 3)))
    return F.concat_ws(" ", new["family"], new["name"], new["patronymic"])


def fake_initials(salt: str, corpora: dict, family: str, name: str, patronymic: str) -> Column:
    """ "Surname A. B.", the surname as in the full form, the initials out of the one-letter keys' fakes; null without a surname."""
    letter = lambda x: f"substr(trim({x}), 1, 1)"
    new = fake_fio(salt, corpora, family, letter(name), letter(patronymic))
    dot = lambda part: F.concat(F.substring(new[part], 1, 1), F.lit("."))
    return F.when(new["family"].isNotNull(), F.concat_ws(" ", new["family"], dot("name"), dot("patronymic")))
