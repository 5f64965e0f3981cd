"""Format-preserving pseudonyms of personal numbers and dates, with built-in functions only.

Values are found with one pattern and checked: cards by their check digit, account
numbers by theirs, addresses by their ranges, dates by the calendar. Each valid value is
permuted within its own format by a keyed Feistel network, so equal values get equal
pseudonyms in all documents and different ones stay different, and a valid value stays
valid. Texts of letters and digits are permuted sign by sign: the two halves are shifted
in turn by a keyed digest of the other, each sign within its own class. Numbers of a
range of A * B values are permuted as a pair of numbers below A and B, so no value
falls outside and nothing has to be tried again.

The key is part of the expressions; keep plans and event logs as safe as the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common

ROUNDS = 10
KEY = "tallyline"

# One alternative per kind, in order of precedence; repeats are bounded or possessive.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
#: Account numbers of the registry by their length, so that what stands beside one is not taken in.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![A-Za-z0-9])"


# A code of a country, else of the general form.
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:"
    + "|".join(_iban(n, c) for n, c in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
)
DATE = r"(?<![0-9.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[-./][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
#: Most digits by country code, the code included; other numbers have up to 15.
PHONE_DIGITS = {
    10: "45 47 65", 11: "27 31 32 33 34 36 40 41 48 51 56 61 66 7 94 216 352 370 371 372 386 852",
    12: "20 30 44 46 57 58 60 63 64 81 82 84 90 91 92 98 212 213 351 353 354 359 380 381 385 420 421 966 971 972",
    13: "39 49 52 54 55 86", 14: "62 358",
}


def _abroad(code: str, size: int, most: int) -> str:
    """A code of ``size`` digits and the most digits, 8 to ``most`` with the code, after which a printed group ends."""
    return rf"(?<![0-9A-Za-z])\+{code}(?:\)?[ .-]?\(?[0-9]){{{8 - size},{most - size}}}(?![0-9])"


def _coded(codes: str, most: int) -> str:
    """Numbers of some countries. The code stands by itself, since only then it is kept; a trunk digit in brackets is one more."""
    sizes = {n: "|".join(c for c in codes.split() if len(c) == n) for n in (1, 2, 3)}
    return "|".join(_abroad(rf"(?:{c})(?=[ .-])(?:[ .-]?\([0-9]\))?", n, most) for n, c in sizes.items() if c)


PHONE = (
    r"(?<![0-9A-Za-z])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|"
    + "|".join(_coded(c, n) for n, c in PHONE_DIGITS.items())
    + f"|{_abroad('[0-9]', 1, 15)}"
    + r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}(?![0-9]|[-.][0-9])"
)
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
# Groups in one of the printed forms, so that a number beside a card is not taken for a part of it.
CARD = (
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})"
    r"(?![0-9A-Za-z])"
)
KINDS = {"email": EMAIL, "iban": IBAN, "date": DATE, "ssn": SSN, "phone": PHONE, "ip": IP, "card": CARD}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Days of a whole calendar cycle from FIRST_DAY on: 189 * 773.
FIRST_DAY, DAYS_A, DAYS_B = "1700-01-01", 189, 773
#: Valid areas (001-665, 667-899) times groups, and serials.
SSN_A, SSN_B = 898 * 99, 9999


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Sql:
    """Expressions for one key; ``sign`` is 1 to hide and -1 to restore."""

    def __init__(self, key: str, sign: int):
        self.key, self.sign = key, sign
        self.rounds = f"sequence(0, {ROUNDS - 1})" if sign > 0 else f"sequence({ROUNDS - 1}, 0)"

    def _digest(self, kind: str, half: str, bits: int) -> str:
        return f"sha2(concat_ws('|', {_quoted(self.key)}, '{kind}', k, {half}), {bits})"

    def _shifted(self, x: str, kind: str, other: str) -> str:
        """Half ``x``, each sign moved within its class by four digits of a digest of the other half."""
        step = f"{self.sign} * cast(conv(substr(h, 4 * i - 3, 4), 16, 10) as int)"
        move = lambda a, n: f"chr({a} + pmod(ascii(c) - {a} + {step}, {n}))"
        one = f"CASE WHEN c BETWEEN '0' AND '9' THEN {move(48, 10)} WHEN c BETWEEN 'a' AND 'z' THEN {move(97, 26)} WHEN c BETWEEN 'A' AND 'Z' THEN {move(65, 26)} ELSE c END"
        h = self._digest(kind, other, 512)
        # names for the digest and the sign, so that each is written once
        body = f"transform(array({h}), h -> array_join(transform(sequence(1, length({x})), i -> transform(array(substr({x}, i, 1)), c -> {one})[0]), ''))[0]"
        return f"if(length({x}) = 0, '', {body})"

    def signs(self, x: str, kind: str) -> str:
        """A text of up to 64 signs, permuted within the classes of its signs."""
        half = f"(length({x}) div 2)"
        start = f"named_struct('l', substr({x}, 1, {half}), 'r', substr({x}, {half} + 1))"
        left = f"named_struct('l', {self._shifted('s.l', kind, 's.r')}, 'r', s.r)"
        right = f"named_struct('l', s.l, 'r', {self._shifted('s.r', kind, 's.l')})"
        return f"aggregate({self.rounds}, {start}, (s, k) -> if(k % 2 = 0, {left}, {right}), s -> concat(s.l, s.r))"

    def number(self, x: str, a: int, b: int, kind: str) -> str:
        """A number below a * b, permuted among all of them."""
        f = lambda half: f"{self.sign} * cast(conv(substr({self._digest(kind, half, 256)}, 1, 14), 16, 10) as bigint)"
        start = f"named_struct('l', cast({x} as bigint) div {b}L, 'r', cast({x} as bigint) % {b}L)"
        left = f"named_struct('l', pmod(s.l + {f('s.r')}, {a}L), 'r', s.r)"
        right = f"named_struct('l', s.l, 'r', pmod(s.r + {f('s.l')}, {b}L))"
        return f"aggregate({self.rounds}, {start}, (s, k) -> if(k % 2 = 0, {left}, {right}), s -> s.l * {b}L + s.r)"

    @staticmethod
    def _named(name: str, value: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    @staticmethod
    def _shaped(shape: str, signs: str, kept: str = "0-9") -> str:
        """``shape`` with its signs of a class replaced in order by ``signs``."""
        place = f"length(regexp_replace(substr({shape}, 1, i), '[^{kept}]', ''))"
        return f"array_join(transform(sequence(1, length({shape})), i -> if(substr({shape}, i, 1) rlike '[{kept}]', substr({signs}, {place}, 1), substr({shape}, i, 1))), '')"

    def email(self) -> str:
        return f"concat({self.signs('split_part(m, \'@\', 1)', 'email')}, '@', split_part(m, '@', 2))"

    def card(self) -> str:
        body = self.signs("substr(d, 1, length(d) - 1)", "card")
        whole = self._named("n", body, "concat(n, filter(sequence(0, 9), x -> luhn_check(concat(n, x)))[0])")
        valid = f"if(length(d) BETWEEN 13 AND 19 AND luhn_check(d), {self._named('w', whole, self._shaped('m', 'w'))}, m)"
        return self._named("d", "regexp_replace(m, '[^0-9]', '')", valid)

    def phone(self) -> str:
        lead = "regexp_extract(m, '^[+][0-9]{1,3}[ .-]', 0)"
        rest = f"substr(m, length({lead}) + 1)"
        body = self._named("d", "regexp_replace(t, '[^0-9]', '')", f"if(length(regexp_replace(m, '[^0-9]', '')) BETWEEN 8 AND 15, {self._named('w', self.signs('d', 'phone'), self._shaped('t', 'w'))}, t)")
        return f"concat({lead}, {self._named('t', rest, body)})"

    def ip(self) -> str:
        part = lambda i: f"cast(split_part(m, '.', {i}) as bigint)"
        whole = f"(({part(1)} * 256 + {part(2)}) * 256 + {part(3)}) * 256 + {part(4)}"
        out = self._named("n", self.number(whole, 65536, 65536, "ip"), "concat_ws('.', n div 16777216, n div 65536 % 256, n div 256 % 256, n % 256)")
        octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return f"if(m rlike {_quoted(f'^{octet}(?:[.]{octet}){{3}}$')}, {out}, m)"

    def ssn(self) -> str:
        area, group, serial = ("cast(substr(m, 1, 3) as int)", "cast(substr(m, 5, 2) as int)", "cast(substr(m, 8, 4) as int)")
        index = f"(if({area} < 666, {area} - 1, {area} - 2) * 99 + {group} - 1) * {SSN_B}L + {serial} - 1"
        parts = "transform(array(named_struct('a', n div 9999 div 99, 'g', n div 9999 % 99 + 1, 's', n % 9999 + 1)), q -> concat_ws('-', lpad(if(q.a < 665, q.a + 1, q.a + 2), 3, '0'), lpad(q.g, 2, '0'), lpad(q.s, 4, '0')))[0]"
        valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
        return f"if({valid}, {self._named('n', self.number(index, SSN_A, SSN_B, 'ssn'), parts)}, m)"

    def date(self) -> str:
        """Year first, or day first with dots or strokes; a month behind a stroke if only that is a day."""

        def moved(iso: str, back: str) -> str:
            days = f"datediff(y, DATE'{FIRST_DAY}')"
            new = self._named("z", f"cast(date_add(DATE'{FIRST_DAY}', cast({self.number(days, DAYS_A, DAYS_B, 'date')} as int)) as string)", back)
            return self._named("y", f"try_cast({iso} as date)", f"if(y IS NOT NULL AND {days} BETWEEN 0 AND {DAYS_A * DAYS_B - 1}, {new}, NULL)")

        day = "concat(substr(m, 7, 4), '-', substr(m, 4, 2), '-', substr(m, 1, 2))"
        month = "concat(substr(m, 7, 4), '-', substr(m, 1, 2), '-', substr(m, 4, 2))"
        day_back = "concat(substr(z, 9, 2), substr(m, 3, 1), substr(z, 6, 2), substr(m, 3, 1), substr(z, 1, 4))"
        month_back = "concat(substr(z, 6, 2), '/', substr(z, 9, 2), '/', substr(z, 1, 4))"
        return (
            f"CASE WHEN substr(m, 5, 1) = '-' THEN coalesce({moved('m', 'z')}, m) "
            f"ELSE coalesce({moved(day, day_back)}, if(substr(m, 3, 1) = '/', {moved(month, month_back)}, NULL), m) END"
        )

    def iban(self) -> str:
        # letters count as 10 to 35 in the remainder by 97
        rest = lambda x: (
            f"aggregate(sequence(1, length({x})), 0, (r, i) -> if(substr({x}, i, 1) BETWEEN '0' AND '9', (r * 10 + cast(substr({x}, i, 1) as int)) % 97, (r * 100 + ascii(substr({x}, i, 1)) - 55) % 97))"
        ).replace("cast(substr", "try_cast(substr")
        check = lambda b: f"lpad(98 - {rest(f'concat({b}, substr(d, 1, 2), \'00\')')}, 2, '0')"
        new = self._named("b", self.signs("substr(d, 5)", "iban"), f"concat(substr(d, 1, 2), {check('b')}, b)")
        valid = f"length(d) BETWEEN 15 AND 34 AND substr(d, 3, 2) = {check('substr(d, 5)')}"
        return self._named("d", "replace(m, ' ', '')", f"if({valid}, {self._named('w', new, self._shaped('m', 'w', 'A-Z0-9'))}, m)")

    def kind(self) -> str:
        """Which alternative a match is: the first one that matches it as a whole."""
        tests = {
            "email": "contains(m, '@')",
            "iban": "m rlike '^[A-Z]{2}'",
            "date": "m rlike '^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}[./][0-9]{4})$'",
            "ssn": "m rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'",
            "phone": "m rlike '^([+(]|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}$)'",
            "ip": "m rlike '^([0-9]{1,3}[.]){3}[0-9]{1,3}$'",
        }
        return "CASE " + " ".join(f"WHEN {t} THEN '{k}'" for k, t in tests.items()) + " ELSE 'card' END"

    def value(self) -> str:
        """Kind and new form of the match ``m``; an invalid one stays as it is."""
        by_kind = " ".join(f"WHEN '{k}' THEN {getattr(self, k)()}" for k in KINDS)
        return f"named_struct('kind', {self.kind()}, 'old', m, 'new', CASE {self.kind()} {by_kind} END)"


def pseudonymised(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text", restore: bool = False) -> DataFrame:
    """doc_id, text, found (array of kind and pseudonym): one row per row of ``docs``.

    ``found`` lists the valid values in order; numbers that fail their check stay in the
    text and are not listed. Null text is empty. Repeated rows stay repeated; other
    columns are not looked at. With ``restore`` the same key gives the old values back
    (dates written month first only if they are not days first as well).
    """
    values = F.expr(f"transform(found, m -> {Sql(key, -1 if restore else 1).value()})")
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("t"))
    rows = rows.withColumn("found", F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0)))
    # what stands between the matches: one piece more than matches
    rows = rows.withColumn("between", F.when(F.size("found") > 0, F.split("t", PATTERN, -1)))
    rows = rows.withColumn("values", F.when(F.size("found") > 0, values))
    text = F.expr("concat(array_join(zip_with(slice(between, 1, size(values)), values, (p, v) -> concat(p, v.new)), ''), element_at(between, -1))")
    valid = F.expr("transform(filter(values, v -> v.new <> v.old), v -> named_struct('kind', v.kind, 'pseudonym', v.new))")
    none = F.expr("cast(array() as array<struct<kind:string,pseudonym:string>>)")
    return rows.select("doc_id", F.coalesce(text, F.col("t")).alias("text"), F.coalesce(valid, none).alias("found"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pseudonymised(common.table(spark, sf_dir, "documents"))
    said = F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["pseudonym"]))
    return rows.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), F.array_join(said, ",").alias("pseudonyms"))
