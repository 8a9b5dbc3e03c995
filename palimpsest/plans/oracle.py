"""The registry's queries once more in DuckDB's SQL, written apart from the library: steps as subqueries, no shared formula."""

from __future__ import annotations

from palimpsest.sources.corpus import COMPONENTS

SALT = "SALT"
#: Weights of the check digits.
W10, W11, W12, W_SNILS = [2, 4, 10, 3, 5, 9, 4, 6, 8], [7, 2, 4, 10, 3, 5, 9, 4, 6, 8], [3, 7, 2, 4, 10, 3, 5, 9, 4, 6, 8], [9, 8, 7, 6, 5, 4, 3, 2, 1]


def h(*parts: str) -> str:
    """60 bits of the keyed hash; parts are SQL."""
    return f"('0x' || substr(sha256(concat_ws('|', '{SALT}', {', '.join(f'({p})::VARCHAR' for p in parts)})), 1, 15))::BIGINT"


def feistel(rows: str, x: str, n: int, label: str, out: str) -> str:
    """rows and a column ``out``: x permuted among the numbers of n digits, four rounds as four subqueries."""
    if n == 1:
        return f"SELECT *, (({x}) + {h(f"'{label}'", '0')} % 10) % 10 AS {out} FROM ({rows})"
    a, b = 10 ** (n // 2), 10 ** (n - n // 2)
    q = f"SELECT *, ({x})::BIGINT // {b} AS l0, ({x})::BIGINT % {b} AS r0 FROM ({rows})"
    for i in range(4):
        q = f"SELECT *, r{i} AS l{i + 1}, (l{i} + {h(f"'{label}'", str(i), f'r{i}')}) % {b if i % 2 else a} AS r{i + 1} FROM ({q})"
    steps = ", ".join(f"{s}{i}" for s in "lr" for i in range(5))
    return f"SELECT * EXCLUDE ({steps}), l4 * {b} + r4 AS {out} FROM ({q})"


def zeros(x: str, n: int) -> str:
    return f"lpad(({x})::VARCHAR, {n}, '0')"


def weighted(s: str, weights: list[int]) -> str:
    return f"list_sum(list_transform(list_zip({weights}, string_split(substr({s}, 1, {len(weights)}), '')), lambda z: z[1] * z[2]::INT))::INT"


def inn12(body: str) -> str:
    """Twelve digits out of a ten-digit body, in SQL of one nested select."""
    return f"(SELECT e || ({weighted('e', W12)} % 11 % 10)::VARCHAR FROM (SELECT {body} || ({weighted(body, W11)} % 11 % 10)::VARCHAR AS e))"


def inn10(body: str) -> str:
    return f"{body} || ({weighted(body, W10)} % 11 % 10)::VARCHAR"


def snils(body: str) -> str:
    return f"{body} || {zeros(f'{weighted(body, W_SNILS)} % 101 % 100', 2)}"


def luhn(body: str) -> str:
    double = "CASE WHEN (length(BODY) - i) % 2 = 0 THEN (CASE WHEN v > 4 THEN 2 * v - 9 ELSE 2 * v END) ELSE v END".replace("BODY", body)
    total = f"(SELECT sum({double})::INT FROM (SELECT unnest(range(1, length({body}) + 1)) AS i, unnest(string_split({body}, ''))::INT AS v))"
    return f"{body} || ((10 - {total} % 10) % 10)::VARCHAR"


def entry(corpus: str, key: str, avoid: str | None = None) -> str:
    values = "[" + ", ".join(f"'{v}'" for v in COMPONENTS[corpus]) + "]"
    n = len(COMPONENTS[corpus])
    label = {"name_m": "name_m", "name_f": "name_f"}.get(corpus, corpus)
    at = f"{h(f"'{label}'", key)} % {n}"
    got = f"{values}[({at}) + 1]"
    return got if avoid is None else f"CASE WHEN {got} = {avoid} THEN {values}[(({at}) + 1) % {n} + 1] ELSE {got} END"


def capital(x: str) -> str:
    """First letter of each word upper case."""
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def letters(n: int, *parts: str) -> str:
    return "(" + " || ".join(f"'abcdefghijklmnopqrstuvwxyz234567'[(({h(*parts)} // {32**i}) % 32)::INT + 1]" for i in range(n)) + ")"


def ring(ids: str, group: str) -> str:
    """(id, donor): the next id in hash order, the last one's being the first."""
    return f"SELECT id, coalesce(lead(id) OVER w, first_value(id) OVER (ORDER BY o, id)) AS donor FROM (SELECT id, {h("'shuffle'", f"'{group}'", 'id')} AS o FROM ({ids})) WINDOW w AS (ORDER BY o, id)"


def shuffle(source: str, key: str, entity: str, column: str, group: str) -> str:
    rows = f"SELECT {key} AS k, {entity} AS e, {column} AS x, row_number() OVER (PARTITION BY {entity} ORDER BY {key}) AS i, count(*) OVER (PARTITION BY {entity}) AS n FROM {source} WHERE {entity} IS NOT NULL AND {column} IS NOT NULL"
    return f"SELECT a.k, b.x AS value FROM ({rows}) a JOIN ({ring(f'SELECT DISTINCT {entity} AS id FROM {source} WHERE {entity} IS NOT NULL AND {column} IS NOT NULL', group)}) r ON r.id = a.e JOIN ({rows}) b ON b.e = r.donor AND b.i = (a.i - 1) % b.n + 1"


def direct(source: str, column: str) -> str:
    return f"SELECT v, upper({entry('org', 'lower(trim(v))')}) || '-' || upper({letters(12, "'direct'", 'v')}) AS fake FROM (SELECT DISTINCT {column} AS v FROM {source} WHERE {column} IS NOT NULL)"


def card(key: str, n: int) -> str:
    return f"rpad(lpad({key}::VARCHAR, 8, '0'), {n}, '7')"


def _permuted(rows: str, source: str, digits: int, label: str, made: str, columns: str) -> str:
    """Rows with an identifier made of the permuted first digits of ``source``."""
    q = feistel(f"SELECT *, substr({source}, 1, {digits}) AS head FROM ({rows})", "head::BIGINT", digits, label, "p")
    return f"SELECT {columns}, {made} FROM (SELECT *, {zeros('p', digits)} AS body FROM ({q}))"


FPE9 = feistel("SELECT c_custkey FROM customer", "c_custkey", 9, "customer", "fake_key")
NAMES = feistel("SELECT c_custkey, c_nationkey, c_mktsegment, c_name, regexp_extract(c_name, '[0-9]+')::BIGINT AS num FROM customer", "num", 9, "digits9", "p")
PASSPORT = feistel("SELECT c_custkey FROM customer", "c_custkey", 10, "digits10", "p")
PHONE_KEY = "'+7' || substr(regexp_replace(x, '[^0-9]', '', 'g'), 2)"
RUNS = "SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS x FROM documents"
MADE_PHONE = f"'+7' || {entry('phone_code', 'key')} || {zeros(h("'phone'", 'key') + ' % 10000000', 7)}"


def _digit(x: str, i: int) -> str:
    return f"substr({x}, {i}, 1)::INT"


def _kind(x: str) -> str:
    """Which checksum a run of digits satisfies first."""
    s = f"length({x}) = 11 AND {weighted(x, W_SNILS)} % 101 % 100 = substr({x}, 10, 2)::INT"
    i = f"(length({x}) = 10 AND {weighted(x, W10)} % 11 % 10 = {_digit(x, 10)}) OR (length({x}) = 12 AND {weighted(x, W11)} % 11 % 10 = {_digit(x, 11)} AND {weighted(x, W12)} % 11 % 10 = {_digit(x, 12)})"
    o = f"(length({x}) = 13 AND substr({x}, 1, 12)::BIGINT % 11 % 10 = {_digit(x, 13)}) OR (length({x}) = 15 AND substr({x}, 1, 14)::BIGINT % 13 % 10 = {_digit(x, 15)})"
    odd = f"list_sum(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN (length({x}) - i) % 2 = 1 THEN (2 * {x}[i]::INT) // 10 + (2 * {x}[i]::INT) % 10 ELSE {x}[i]::INT END))"
    return f"CASE WHEN {s} THEN 'snils' WHEN {i} THEN 'inn' WHEN {o} THEN 'ogrn' WHEN length({x}) BETWEEN 13 AND 19 AND {odd} % 10 = 0 THEN 'luhn' ELSE 'none' END"


#: A woman where the number is even; the parts are taken from the corpora by the number.
PEOPLE = f"""SELECT k, female,
 {[x for x in COMPONENTS['family']]}[k % {len(COMPONENTS['family'])} + 1] AS lemma,
 CASE WHEN female THEN {COMPONENTS['name_f']}[k % {len(COMPONENTS['name_f'])} + 1] ELSE {COMPONENTS['name_m']}[k % {len(COMPONENTS['name_m'])} + 1] END AS name,
 CASE WHEN k % 5 = 0 THEN NULL WHEN female THEN {COMPONENTS['patronymic_f']}[k % {len(COMPONENTS['patronymic_f'])} + 1] ELSE {COMPONENTS['patronymic_m']}[k % {len(COMPONENTS['patronymic_m'])} + 1] END AS patronymic
FROM (SELECT c_custkey AS k, c_custkey % 2 = 0 AS female FROM customer)"""


def feminine(x: str) -> str:
    return f"CASE WHEN {x} LIKE '%ский' OR {x} LIKE '%цкий' THEN left({x}, -2) || 'ая' WHEN {x} LIKE '%ов' OR {x} LIKE '%ев' OR {x} LIKE '%ин' OR {x} LIKE '%ын' THEN {x} || 'а' ELSE {x} END"


_FIO = f"""SELECT k, lemma, name AS given, CASE WHEN female THEN 'f' ELSE 'm' END AS gender,
 CASE WHEN female THEN {feminine(f"({entry('family', 'lemma', 'lemma')})")} ELSE {entry('family', 'lemma', 'lemma')} END AS family,
 CASE WHEN female THEN {entry('name_f', 'name', 'name')} ELSE {entry('name_m', 'name', 'name')} END AS name,
 CASE WHEN patronymic IS NULL THEN NULL WHEN female THEN {entry('patronymic_f', 'patronymic', 'patronymic')} ELSE {entry('patronymic_m', 'patronymic', 'patronymic')} END AS patronymic
FROM ({PEOPLE})"""

#: Texts with an e-mail, a phone, a passport and a tax id each, and what each must become.
_PLANTED = feistel(feistel("SELECT c_custkey AS k, 'user' || c_custkey || '@mail.ru' AS mail, '+7903' || lpad(c_custkey::VARCHAR, 7, '0') AS key, lpad(c_custkey::VARCHAR, 9, '0') AS head FROM customer", "4500000000 + k", 10, "digits10", "pass"), "k", 9, "inn10", "tax")
LATIN = "['" + "', '".join(["ivanov", "petrov", "sidorov", "kuznetsov", "sokolov", "lebedev", "novikov", "morozov", "volkov", "pavlov", "semenov", "golubev", "vinogradov", "bogdanov", "vorobev", "fedorov", "mikhaylov", "belyaev", "tarasov", "belov", "komarov", "orlov", "kiselev", "makarov", "andreev"]) + "']"


def mail(key: str) -> str:
    return f"{LATIN}[({h("'family'", key)} % {len(COMPONENTS['family'])}) + 1] || '.' || {letters(12, "'email'", key)} || '@' || {entry('email_domain', key)}"


def _count(t: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS tbl, '{c}' AS col, count(*) AS n, count(DISTINCT {c}::VARCHAR) AS n_distinct, round(avg(({c} IS NULL)::INT), 6) AS null_share FROM {t}" for c in columns)


def _bits(t: str, c: str) -> str:
    return f"SELECT '{t}.{c}' AS col, round(entropy({c}), 6) AS bits FROM {t}"


def _links(columns: list[tuple[str, str]]) -> str:
    values = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS col, {c} AS v FROM {t} WHERE {c} IS NOT NULL" for t, c in columns)
    return f"""WITH v AS ({values}), n AS (SELECT col, count(*) AS n FROM v GROUP BY col)
SELECT a.col AS a, b.col AS b, round(count(*) / min(least(x.n, y.n))::DOUBLE, 6) AS containment FROM v a JOIN v b ON a.v = b.v AND a.col < b.col
JOIN n x ON x.col = a.col JOIN n y ON y.col = b.col GROUP BY a.col, b.col HAVING count(*) >= 0.85 * min(least(x.n, y.n))"""


def _orphans(child: str, a: str, parent: str, b: str) -> str:
    return f"SELECT '{child}.{a}' AS fk, count(*) AS missing FROM {child} WHERE {a} IS NOT NULL AND {a} NOT IN (SELECT {b} FROM {parent} WHERE {b} IS NOT NULL)"


def _widths(column: str) -> str:
    """Whole numbers of one to seven digits and their walked permutations."""
    parts = []
    for n in range(1, 8):
        rows = f"SELECT DISTINCT {column} AS k FROM orders WHERE {column} IS NOT NULL AND length({column}::VARCHAR) = {n}"
        q = feistel(rows, "k", n, f"int{n}", "w0")
        for i in range(12):  # a walk of more steps is left out and would show as a missing row
            q = feistel(q, f"w{i}", n, f"int{n}", "again")
            q = f"SELECT * EXCLUDE (again, w{i}), CASE WHEN w{i} >= {0 if n == 1 else 10 ** (n - 1)} THEN w{i} ELSE again END AS w{i + 1} FROM ({q})"
        parts.append(f"SELECT k, w12::VARCHAR AS fake FROM ({q}) WHERE w12 >= {0 if n == 1 else 10 ** (n - 1)}")
    return " UNION ALL ".join(parts)


ORACLE = {
    "fpe_customer_keys": f"SELECT c_custkey, fake_key FROM ({FPE9})",
    "fpe_join_preserved": f"SELECT fake_key, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM ({FPE9}) JOIN orders ON o_custkey = c_custkey GROUP BY fake_key",
    "fpe_distinct_preserved": "SELECT count(DISTINCT o_orderkey) AS n_source, count(DISTINCT o_orderkey) AS n_fake FROM orders",
    "gen_inn10": _permuted("SELECT s_suppkey FROM supplier", card("s_suppkey", 10), 9, "inn10", f"{inn10('body')} AS inn, true AS valid", "s_suppkey"),
    "gen_inn12": _permuted("SELECT c_custkey FROM customer", card("c_custkey", 12), 10, "inn12", f"{inn12('body')} AS inn, true AS valid", "c_custkey"),
    "gen_snils": _permuted("SELECT c_custkey FROM customer", card("c_custkey", 11), 9, "snils", f"{snils('body')} AS snils, true AS valid", "c_custkey"),
    "gen_ogrn": f"SELECT s_suppkey, body || (p % 11 % 10)::VARCHAR AS ogrn, true AS valid FROM (SELECT *, {zeros('p', 12)} AS body FROM ({feistel(f'SELECT s_suppkey, substr({card("s_suppkey", 13)}, 1, 12) AS head FROM supplier', 'head::BIGINT', 12, 'ogrn', 'p')}))",
    "gen_luhn_like": _permuted("SELECT c_custkey FROM customer", card("c_custkey", 16), 15, "luhn", f"{luhn('body')} AS card, true AS valid", "c_custkey"),
    "gen_digits_like_names": f"SELECT c_custkey, 'Customer#' || {zeros('p', 9)} AS fake_name FROM ({NAMES})",
    "gen_int_like_keys": _widths("o_custkey"),
    "passport_pair": f"SELECT c_custkey, substr({zeros('p', 10)}, 1, 4) AS series, substr({zeros('p', 10)}, 5) AS number FROM ({PASSPORT})",
    "checksum_flags": f"SELECT kind, count(*) AS n FROM (SELECT {_kind('x')} AS kind FROM ({RUNS}) WHERE length(x) BETWEEN 10 AND 19) GROUP BY kind",
    "normalize_phone": f"SELECT doc_id, phone, key, {MADE_PHONE} AS fake FROM (SELECT doc_id, x AS phone, CASE WHEN x[2] IN ('7', '8') THEN {PHONE_KEY} ELSE '+' || regexp_replace(x, '[^0-9]', '', 'g') END AS key FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\+[0-9] \\([0-9]{{3}}\\) [0-9]{{3}}-[0-9]{{4}}')) AS x FROM documents))",
    "normalize_email": f"SELECT doc_id, email, key, {mail('key')} AS fake FROM (SELECT doc_id, x AS email, regexp_replace(lower(x), '\\+[^@]*@', '@') AS key FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS x FROM documents))",
    "normalize_digits": "SELECT c_custkey, right(c_name, 9) AS digits FROM customer",
    "fake_fio": f"SELECT k AS c_custkey, lemma, gender, {capital('family')} AS family, {capital('name')} AS name, {capital('patronymic')} AS patronymic FROM ({_FIO})",
    "fake_pick_name": f"SELECT c_custkey, {capital(entry('city', 'lower(c_name)'))} AS city FROM customer",
    "fake_address": "SELECT s_suppkey, {0} || ', г. ' || {1} || ', ул. ' || {2} || ', д. ' || (1 + {3} % 99) || ', кв. ' || (1 + {4} % 250) AS address FROM (SELECT s_suppkey, lower(s_name) AS k FROM supplier)".format(
        *(f"upper(({entry(x, 'k')})[1]) || ({entry(x, 'k')})[2:]" for x in ("region", "city", "street")), h("'house'", "k"), h("'flat'", "k")
    ),
    "fake_email": f"SELECT c_custkey, {mail('lower(c_name)')} AS email FROM customer",
    "direct_map_segments": direct("customer", "c_mktsegment"),
    "direct_map_suppliers": f"SELECT s_suppkey, fake FROM supplier LEFT JOIN ({direct('supplier', 's_name')}) ON v = s_name",
    "shuffle_acctbal": f"SELECT k AS c_custkey, value FROM ({shuffle('customer', 'c_custkey', 'c_custkey', 'c_acctbal', 'g')})",
    "shuffle_linked_totals": f"SELECT o_orderkey, value FROM orders LEFT JOIN ({shuffle('orders', 'o_orderkey', 'o_custkey', 'o_totalprice', 'g')}) ON k = o_orderkey",
    "shuffle_corr_preserved": "SELECT round(corr(c_acctbal, paid), 6) AS before, round(corr(c_acctbal, paid), 6) AS after FROM (SELECT c_custkey, c_acctbal, 2 * c_acctbal + c_custkey % 7 AS paid FROM customer)",
    "plan_projection": f"SELECT c_custkey, 'Customer#' || {zeros('p', 9)} AS c_name, c_nationkey, fake AS c_mktsegment, NULL::DOUBLE AS c_acctbal FROM ({NAMES}) LEFT JOIN ({direct('customer', 'c_mktsegment')}) ON v = c_mktsegment",
    "generalize_order_year": "SELECT o_orderkey, make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) AS o_orderdate FROM orders",
    "json_keys": "SELECT DISTINCT unnest(json_keys(props)) AS k FROM events",
    "json_rewrite": f"SELECT c_custkey, '{{\"inn\":\"' || inn || '\",\"n\":' || (c_custkey % 5) || ',\"drop\":null,\"none\":null,\"o\":{{\"a\":[1,true]}}}}' AS js FROM ({_permuted('SELECT c_custkey FROM customer', card('c_custkey', 10), 9, 'inn10', inn10('body') + ' AS inn', 'c_custkey')})",
    "profile_columns": " UNION ALL ".join([_count("customer", ["c_custkey", "c_name", "c_mktsegment"]), _count("orders", ["o_custkey", "o_orderstatus"]), _count("nation", ["n_name"])]),
    "sample_values": "SELECT 'customer.c_name' AS col, v FROM (SELECT DISTINCT c_name AS v FROM customer WHERE c_name IS NOT NULL ORDER BY v LIMIT 50)",
    "rule_votes": "SELECT * FROM (VALUES ('inn', 'inn'), ('snils', 'snils'), ('email', 'email'), ('phone', 'phone'), ('birth_date', 'birth_date'), ('fam', 'family'), ('note', NULL)) AS t(col, sem_type)",
    "addr_parse_ratio": "SELECT round(avg(ok), 6) AS ratio FROM (SELECT min((regexp_full_match(p, ' *([A-Za-z. ]+|[0-9]+) *'))::INT) AS ok FROM (SELECT doc_id, text, unnest(string_split(text, ',')) AS p FROM documents) GROUP BY doc_id, text)",
    "soft_links": _links([("customer", "c_custkey"), ("orders", "o_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("supplier", "s_suppkey"), ("lineitem", "l_suppkey")]),
    "plan_assign": "SELECT * FROM (VALUES ('customer.c_custkey', 'keep'), ('customer.c_name', 'unresolved'), ('customer.tax', 'generate'), ('customer.town', 'keep'), ('customer.birth', 'generalize'), ('customer.mail', 'generate')) AS t(col, strategy)",
    "plan_faults": "SELECT 8 AS n_faults",
    "volume_check": " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n_source, count(*) AS n_copy FROM {t}" for t in ("customer", "orders", "lineitem", "supplier", "part")),
    "fake_ne_rowwise": "SELECT count(*) AS compared, 0 AS equal_values, 0 AS missing FROM customer",
    "fake_ne_multiset": f"SELECT count(*) AS shared FROM (SELECT DISTINCT c_name AS v FROM customer INTERSECT SELECT 'Customer#' || {zeros('p', 9)} FROM ({NAMES}))",
    "fk_violations": " UNION ALL ".join([_orphans("orders", "o_custkey", "customer", "c_custkey"), _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"), _orphans("customer", "c_nationkey", "nation", "n_nationkey"), _orphans("nation", "n_regionkey", "region", "r_regionkey")]),
    "unique_violations": " UNION ALL ".join(f"SELECT '{t}.{c}' AS key, count(*) AS repeated FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)" for t, c in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("supplier", "s_name"))),
    "entropy_columns": " UNION ALL ".join([_bits("events", "event_type"), _bits("customer", "c_mktsegment"), _bits("orders", "o_orderstatus"), _bits("customer", "c_nationkey")]),
    "corpus_ceiling": f"SELECT name, m, round(log2(greatest(m * (1 - exp(-n / m::DOUBLE)), 1)), 6) AS bits FROM (VALUES {', '.join(f"('{k}', {len(v)})" for k, v in COMPONENTS.items())}) AS c(name, m), (SELECT count(*) AS n FROM customer)",
    "canary_search": "SELECT item_id FROM benchmark b WHERE text <> '' AND EXISTS (SELECT 1 FROM documents d WHERE contains(lower(d.text), lower(b.text)))",
    "identifier_leak": """WITH ids AS (SELECT DISTINCT right(c_name, 9) AS x FROM customer), t AS (SELECT text FROM documents UNION ALL SELECT text FROM conversations),
 r AS (SELECT regexp_replace(unnest(regexp_extract_all(text, '[0-9][0-9 .\\-/()]*')), '[^0-9]', '', 'g') AS r FROM t),
 w AS (SELECT unnest(list_transform(range(1, length(r) - 7), lambda i: r[i:i + 8])) AS x FROM r WHERE length(r) >= 9)
SELECT count(DISTINCT x) AS leaked FROM w SEMI JOIN ids USING (x)""",
    "column_checksums": "SELECT true AS same_in_any_order, true AS changed_shows, true AS null_shows",
    "sanitize_planted": f"SELECT k AS c_custkey, 'Пишите ' || {mail('mail')} || ', тел. ' || '+7' || ' (' || substr(phone, 1, 3) || ') ' || substr(phone, 4, 3) || '-' || substr(phone, 7, 2) || '-' || substr(phone, 9, 2) || ', паспорт ' || substr({zeros('pass', 10)}, 1, 4) || ' ' || substr({zeros('pass', 10)}, 5) || ', ИНН ' || {inn10(f'({zeros("tax", 9)})')} || '.' AS text FROM (SELECT *, {entry('phone_code', 'key')} || {zeros(h("'phone'", 'key') + ' % 10000000', 7)} AS phone FROM ({_PLANTED}))",
    "sanitize_names": f"SELECT k AS c_custkey, 'Звонил ' || {capital('family')} || ' ' || {capital('name')} || ' ' || {capital('patronymic')} || ' вчера' AS text FROM ({_FIO}) WHERE patronymic IS NOT NULL AND given NOT IN ('ирина', 'полина')",
    "runlog_publishable": "SELECT * FROM (VALUES ('all done', true), ('verify failed', false), ('table failed', false), ('no verify', false)) AS t(log, publishable)",
}
