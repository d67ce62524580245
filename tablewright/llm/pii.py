"""Format-preserving pseudonyms for personal data, in SQL expressions only.

Candidates are validated (check digits, calendar, ranges); where the longest one at a place fails, shorter ones and other
kinds are tried there, and the search goes on after the first that is valid. Each valid value is replaced by a keyed
permutation of its own format: a Feistel network over the value's characters, or over a pair of residues for numbers
with gaps. Being a permutation, equal values get equal pseudonyms in every document and different ones stay different;
the result validates as the value did. Separators stay where they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import unused

ROUNDS = 8

_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}" + _END
SECRET = r"AKIA[0-9A-Z]{16}" + _END
ASSIGNED = r"(?:token|secret|password|api_key) = \"[0-9A-Za-z]{16,}\""
#: Kinds without a check; at one place in this order.
SURE = [("secret", SECRET), ("assigned", ASSIGNED)]
PATTERN = EMAIL + "|" + _EDGE + "(?:" + "|".join(p for _, p in SURE) + ")"

#: The longest that an IBAN or card at a place can be; its beginnings are tried too.
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}" + _END
IP = r"(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])"
DATE = (r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?:(?=T[0-9]{2}(?::?[0-9]{2}|(?![0-9A-Za-z])))|" + _END + r")|(?:[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})" + _END + ")")
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END
_LOCAL = r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}" + _END
#: A number after + takes no group with which a local number or a date starts.
PHONE = (r"(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})"
         rf"|\+[0-9]{{1,3}}[ .-](?:[0-9][ .-])?[0-9]{{2,4}}(?:[ .-]?(?!{_LOCAL}|{DATE})[0-9]{{2,4}}){{1,4}}|\+[0-9]{{8,15}})" + _END)
START = _EDGE + "(?=" + "|".join([IBAN, DATE, SSN, IP, CARD, PHONE]) + ")"
#: How cards are printed: in one piece or in their usual groups; and what a card followed by other numbers looks like at least.
CARD_GROUPS = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
CARD_LEAST = r"^[0-9]{3,}(?:[ -][0-9]{3,})*$"
#: Characters of an IBAN by country.
IBAN_SIZES = ("AD24AE23AL28AT20AZ28BA20BE16BG22BH22BI27BR29BY28CH21CR22CY28CZ24DE22DJ27DK18DO28EE20EG29ES24FI18FK18FO18FR27GB22GE22GI23GL18GR27GT28"
              "HR21HU28IE22IL23IQ23IS26IT27JO30KW30KZ20LB28LC32LI21LT20LU20LV21LY25MC27MD24ME22MK19MN20MR27MT31MU30NI28NL18NO15OM23PK24PL28PS29PT25"
              "QA29RO24RS22RU33SA24SC31SD18SE24SI19SK24SM27SO23ST25SV28TL23TN24TR26UA29VA22VG24XK20YE30")
#: Pieces of text that hold any value of a checked kind: each has a character at least.
REACH = 64
RUN = 256  # pieces of a text put together at a time

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WALK = 128
_FIRST_DAY, _DAYS = "1700-01-01", (189, 773)  # 400 Gregorian years have 146,097 = 189 x 773 days


def _sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for the value, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _chars(s: str) -> str:
    return f"filter(split({s}, ''), x -> x <> '')"


def _shift(s: str, pad: str, alphabets: list[str]) -> str:
    """Each character of ``s`` moved within its alphabet by eight hex digits of ``pad``, an array of 64 digits each; others stay."""
    cases = " ".join(
        f"when instr({_sql(a)}, c) > 0 then substr({_sql(a)}, cast((instr({_sql(a)}, c) - 1 + cast(conv(substr(p[i div 8], 8 * (i % 8) + 1, 8), 16, 10) as bigint)) % {len(a)} as int) + 1, 1)"
        for a in alphabets)
    return _let(pad, "p", f"array_join(transform({_chars(s)}, (c, i) -> case {cases} else c end), '')")


def feistel_text(s: str, key: str, kind: str, alphabets: list[str]) -> str:
    """A keyed permutation of the strings with the same alphabet at every place. ``s``: a variable or column name."""
    pad = (f"transform(sequence(0, cast(length(h.a) div 8 as int)), b -> "
           f"sha2(concat_ws('|', {key}, '{kind}', r, b, h.b), 256))")
    # a round shifts the first half by the second and swaps them; an even number of rounds restores their places
    step = f"named_struct('a', h.b, 'b', {_shift('h.a', pad, alphabets)})"
    start = f"named_struct('a', substr({s}, 1, cast(length({s}) div 2 as int)), 'b', substr({s}, cast(length({s}) div 2 as int) + 1))"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (h, r) -> {step}, h -> concat(h.a, h.b))"


def feistel_number(a: str, b: str, sizes: tuple[int, int], key: str, kind: str) -> str:
    """A keyed permutation of pairs (a, b) below ``sizes``; the result is the struct (a, b)."""
    def shifted(x: str, y: str, m: int, side: str) -> str:
        return f"(h.{x} + cast(conv(substr(sha2(concat_ws('|', {key}, '{kind}', r, '{side}', h.{y}), 256), 1, 13), 16, 10) as bigint)) % {m}L"
    step = f"if(r % 2 = 0, named_struct('a', {shifted('a', 'b', sizes[0], 'a')}, 'b', h.b), named_struct('a', h.a, 'b', {shifted('b', 'a', sizes[1], 'b')}))"
    return f"aggregate(sequence(1, {ROUNDS}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (h, r) -> {step})"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _refill(m: str, chars: str, keep: str = "[^0-9]") -> str:
    """The characters of ``chars`` put in the places of ``m`` that do not match ``keep``."""
    return (f"array_join(transform({_chars(m)}, (c, i) -> if(c rlike '{keep}', c, "
            f"substr({chars}, length(regexp_replace(substr({m}, 1, i + 1), '{keep}', '')), 1))), '')")


def _luhn(d: str, double_last: bool) -> str:
    """Luhn sum of a digit string; ``double_last``: the last digit counts doubled (it stands before the check digit)."""
    odd = 0 if double_last else 1
    return (f"aggregate(transform(split(reverse({d}), ''), (c, i) -> if(c = '', 0, if(i % 2 = {odd}, "
            f"cast(c as int) * 2 - if(cast(c as int) > 4, 9, 0), cast(c as int)))), 0, (s, x) -> s + x)")


def _mod97(s: str) -> str:
    """Remainder of an IBAN string in which letters count 10 to 35."""
    return (f"aggregate({_chars(s)}, 0, (s, c) -> if(c rlike '[0-9]', (s * 10 + cast(c as int)) % 97, "
            f"(s * 100 + instr('{_UPPER}', c) + 9) % 97))")


def _date(m: str, key: str) -> str:
    def one(form: str, among: str = "") -> str:
        """Pseudonym in the spelling ``form``; ``among``: a condition on the day n that the value meets, and the result has to."""
        def moved(n: str) -> str:
            pair = feistel_number(f"{n} div {_DAYS[1]}", f"{n} % {_DAYS[1]}", _DAYS, key, "date")
            return _let(pair, "d", f"cast(d.a * {_DAYS[1]} + d.b as int)")
        index = f"datediff(try_to_date({m}, '{form}'), date'{_FIRST_DAY}')"
        # moved again until the day meets the condition, as two days in three do: still a permutation of those days
        to = f"aggregate(sequence(1, {WALK}), {moved('n')}, (n, i) -> if({among}, n, {moved('n')}))" if among else moved("n")
        # a date that is none, or lies outside the 400 years, stays
        return _let(index, "n", f"if(n is null or n < 0 or n >= {_DAYS[0] * _DAYS[1]}, null, " + _let(to, "n", f"date_format(date_add(date'{_FIRST_DAY}', n), '{form}')") + ")")
    # a month first only where the day does not come first
    month_first = one("MM/dd/yyyy", f"day(date_add(date'{_FIRST_DAY}', n)) > 12")
    return (f"case when {m} rlike '^....-' then {one('yyyy-MM-dd')} when {m} rlike '/' then coalesce({one('dd/MM/yyyy')}, "
            f"if(cast(substr({m}, 4, 2) as int) > 12, {month_first}, null)) when {m} rlike '[.]' then {one('dd.MM.yyyy')} end")


def _beginnings(m: str, least: int) -> str:
    """The beginnings of the match ``m`` of the text r, from ``least`` characters, that end where a value can end; longest first."""
    ends = f"substr({m}, k, 1) rlike '[0-9A-Z]' and not substr(r, k + 1, 1) rlike '[0-9A-Za-z]'"
    return f"if(length({m}) < {least}, cast(array() as array<string>), transform(filter(sequence(length({m}), {least}, -1), k -> {ends}), k -> substr({m}, 1, k)))"


def _first(values: str, new: str) -> str:
    """(old, new) of the first of ``values`` whose pseudonym, an expression of m, is not null; else null."""
    none = "cast(null as struct<old:string,new:string>)"
    return f"aggregate({values}, {none}, (s, m) -> if(s is not null, s, " + _let(new, "v", f"if(v is null, {none}, named_struct('old', m, 'new', v))") + "))"


def _replace(key: str) -> tuple[str, str]:
    """SQL for the pseudonym of a match m of PATTERN, and for (old, new) of the first valid value at the start of text r, after characters c."""
    alnum = ["0123456789", _LOWER, _UPPER]
    d = _digits("m")
    card = _let(d, "d", f"if(length(d) < 13 or length(d) > 19 or {_luhn('d', False)} % 10 <> 0, null, " + _let(
        "substr(d, 2, length(d) - 2)", "s", _let(feistel_text("s", key, "card", ["0123456789"]), "e", _let(
            "concat(substr(d, 1, 1), e)", "f", _let(f"concat(f, cast((10 - {_luhn('f', True)} % 10) % 10 as string))", "g", _refill("m", "g"))))) + ")")
    phone = _let(d, "d", "if(length(d) < 8 or length(d) > 15, null, " + _let(
        "substr(d, greatest(length(d) - 9, 2 - cast(length(d) >= 10 as int)))", "s", _let(
            feistel_text("s", key, "phone", ["0123456789"]), "e", _let("concat(substr(d, 1, length(d) - length(s)), e)", "g", _refill("m", "g")))) + ")")
    octets = "transform(split(m, '[.]'), x -> cast(x as bigint))"
    ip = _let(octets, "o", "if(exists(o, x -> x > 255), null, " + _let(
        feistel_number("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", (65536, 65536), key, "ip"), "v",
        "concat_ws('.', v.a div 256, v.a % 256, v.b div 256, v.b % 256)") + ")")
    ssn = _let("transform(split(m, '-'), x -> cast(x as bigint))", "o",
               "if(o[0] = 0 or o[0] = 666 or o[0] > 899 or o[1] = 0 or o[2] = 0, null, " + _let(
                   feistel_number("o[0] - 1 - cast(o[0] > 666 as int)", "(o[1] - 1) * 9999 + o[2] - 1", (898, 989901), key, "ssn"), "v",
                   "concat_ws('-', lpad(v.a + 1 + cast(v.a >= 665 as int), 3, '0'), lpad(v.b div 9999 + 1, 2, '0'), lpad(v.b % 9999 + 1, 4, '0'))") + ")")
    bare = "replace(m, ' ', '')"
    iban = _let(bare, "d", f"if({_mod97('concat(substr(d, 5), substr(d, 1, 4))')} <> 1, null, " + _let(
        "substr(d, 5)", "s", _let(feistel_text("s", key, "iban", alnum), "e", _let(
            f"concat(substr(d, 1, 2), lpad(98 - {_mod97('concat(e, substr(d, 1, 2), ' + _sql('00') + ')')}, 2, '0'), e)", "g", _refill("m", "g", "[ ]")))) + ")")
    email = _let("lower(substring_index(m, '.', size(split(m, '[.]')) - 1))", "s", _let(
        feistel_text("s", key, "email", alnum), "e",
        f"array_join(transform({_chars('m')}, (c, i) -> if(i >= length(e), c, if(c rlike '[A-Z]', upper(substr(e, i + 1, 1)), substr(e, i + 1, 1)))), '')"))
    secret = _let("substr(m, 5)", "s", f"concat('AKIA', {feistel_text('s', key, 'secret', ['0123456789', _UPPER])})")
    quoted = _let("regexp_extract(m, '\"(.*)\"', 1)", "s", "concat(substring_index(m, '\"', 1), '\"', "
                  f"if(s rlike '^[0-9a-f]+$', {feistel_text('s', key, 'hex', ['0123456789abcdef'])}, {feistel_text('s', key, 'assigned', alnum)}), '\"')")
    tests = " ".join(f"when m rlike {_sql('^(?:' + p + ')$')} then {by}" for (_, p), by in zip(SURE, (secret, quoted)))
    sure = f"case when instr(m, '@') > 0 then {email} {tests} end"

    def one(pattern: str) -> str:
        # lookbehinds see the two characters before
        return f"filter(array(regexp_extract(concat(c, r), {_sql('(?s)^..(' + pattern + ')')}, 1)), x -> x <> '')"
    iban_size = _let("instr('" + IBAN_SIZES + "', substr(x, 1, 2))", "i", f"i > 0 and length(replace(x, ' ', '')) = cast(substr('{IBAN_SIZES}', i + 2, 2) as int)")
    ibans = _let(f"regexp_extract(r, {_sql('^' + IBAN)}, 0)", "l", _let(_beginnings("l", 12), "all", f"concat(filter(all, x -> {iban_size}), all)"))
    cards = _let(f"regexp_extract(r, {_sql('^' + CARD)}, 0)", "l", _beginnings("l", 13))
    printed = f"filter({cards}, x -> x rlike {_sql(CARD_GROUPS)})"
    # other groups only where a run of digits starts: one in ten of all beginnings in a table of numbers passes the check
    others = _let(cards, "all", f"if(c rlike '[0-9][ -]$', cast(array() as array<string>), filter(all, (x, i) -> i = 0 or x rlike {_sql(CARD_LEAST)}))")
    plus = f"filter({_let(f'regexp_extract(r, {_sql("^" + PHONE)}, 0)', 'l', _beginnings('l', 8))}, (x, i) -> i = 0 or x like '+%')"
    tries = [(ibans, iban), (one(DATE), _date("m", key)), (one(SSN), ssn), (one(IP), ip), (printed, card), (plus, phone), (others, card)]
    return sure, "coalesce(" + ", ".join(_first(values, new) for values, new in tries) + ")"


def _checked(gap: str, found: str) -> str:
    """SQL for (text, n) of a text ``gap``: its values of checked kinds replaced. It is cut wherever one can start."""
    rest = _let("array_join(slice(cut, j, " + str(REACH) + "), '')", "r", _let("right(concat_ws('', slice(cut, greatest(j - 2, 1), least(j - 1, 2))), 2)", "c", found))
    # skip: characters that the last value took from the pieces to come
    step = ("if(s.skip > 0, named_struct('out', concat(s.out, array(substr(cut[j - 1], least(s.skip, length(cut[j - 1])) + 1))), 'skip', greatest(s.skip - length(cut[j - 1]), 0), 'n', s.n), "
            + _let(rest, "f", "if(f is null, named_struct('out', concat(s.out, array(cut[j - 1])), 'skip', 0, 'n', s.n), "
                   "named_struct('out', concat(s.out, array(f.new, substr(cut[j - 1], length(f.old) + 1))), 'skip', greatest(length(f.old) - length(cut[j - 1]), 0), "
                   "'n', s.n + if(f.old <> f.new, 1L, 0L)))") + ")")
    # the pieces are put together RUN at a time, so a list of very many values is not copied for each of them
    run = _let(f"aggregate(sequence(k, least(k + {RUN - 1}, size(cut))), named_struct('out', cast(array() as array<string>), 'skip', a.skip, 'n', a.n), (s, j) -> {step})", "b",
               "named_struct('out', concat(a.out, array(array_join(b.out, ''))), 'skip', b.skip, 'n', b.n)")
    # two characters before the text, so that there are some before every piece but the first
    return _let(f"split(concat('\\n\\n', {gap}), {_sql(START)}, -1)", "cut",
                "if(size(cut) = 1, named_struct('text', " + gap + f", 'n', 0L), aggregate(sequence(2, size(cut), {RUN}), named_struct('out', array(cut[0]), 'skip', 0, 'n', 0L), "
                f"(a, k) -> {run}, a -> named_struct('text', substr(array_join(a.out, ''), 3), 'n', a.n)))")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", into: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text`` pseudonymised in column ``into``; ``count`` names a column for the number replaced.

    Kinds: e-mail addresses, phone numbers, IPv4 addresses, payment cards (Luhn), social security numbers, IBANs (mod 97),
    calendar dates of 1700 to 2099, access keys and quoted secrets. A null text stays null (count 0), an empty one empty;
    text without valid values stays as it is, byte for byte. Any number of rows, repeated or not, is treated row by
    row; ``key`` alone decides the permutation.
    """
    spot = f"`{text}`"
    found = f"regexp_extract_all({spot}, {_sql(PATTERN)}, 0)"
    sure, checked = _replace(_sql(key))
    done = f"transform({found}, m -> named_struct('old', m, 'new', {sure}))"
    # the gaps around n matches are n + 1 pieces
    gaps = f"transform(split({spot}, {_sql(PATTERN)}, -1), g -> {_checked('g', checked)})"
    whole = _let(done, "r0", _let(gaps, "gs", "named_struct('text', array_join(zip_with(gs, r0, (g, x) -> concat(g.text, coalesce(x.new, ''))), ''), "
                                  "'n', aggregate(gs, 0L, (s, g) -> s + g.n) + cast(size(filter(r0, x -> x.old <> x.new)) as bigint))"))
    plain = f"named_struct('text', {spot}, 'n', 0L)"
    name = unused([*docs.columns, into], "_pii")
    held = docs.withColumn(name, F.expr(f'''case when {spot} rlike '[0-9@]|AKIA|= "' then {whole} else {plain} end'''))
    out = [F.col(f"`{c}`") if c != into else F.col(f"{name}.text").alias(into) for c in docs.columns]
    if into not in docs.columns:
        out.append(F.col(f"{name}.text").alias(into))
    return held.select(*out, *([F.col(f"{name}.n").alias(count)] if count else []))
