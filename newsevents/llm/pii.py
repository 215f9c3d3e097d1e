"""Format-preserving pseudonyms for personal numbers, dates and addresses, in SQL alone.

A pattern finds candidates; each kind is validated (Luhn digit, ranges of octets,
calendar, area codes). What is valid is read as a list of numbers, each below
a radix of its own: the payload digits of a card, the indices of area, exchange
and line of a telephone number, four octets, the halves of a day number, the
letters and digits of a mail box. A keyed Feistel network permutes the list:
each round adds a hash of one half (and the key) to the other half, modulo the
radices. It is a bijection within the format, so equal values get equal
pseudonyms in every document, different ones different, and check digits are
made anew.

Days are counted in the 400 years from 1800-01-01, which have 189 * 773 days,
so the two halves cover the calendar exactly.

Everything runs in built-in functions on whole rows: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Longest mail box and domain of an address (RFC 5321).
MAX_BOX, MAX_DOMAIN = 64, 255
KINDS = ("email", "ip", "date", "ssn", "phone", "card")

# The formats searched for, in the order in which they are tried. Java recurses once for each turn of a group that
# may give back, so a repeated group is possessive: a label and its dot are taken if a top level, or a label and a dot, follows.
_BOX, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]++"
EMAIL = (rf"(?<!{_BOX}){_BOX}++@(?:(?:{_LABEL}\.(?=[A-Za-z]{{2}}|{_LABEL}\.[A-Za-z0-9-]))++[A-Za-z]{{2,}}+"
         rf"|{_LABEL}\.[A-Za-z]{{2,}}+)")
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9./])[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (r"(?<![0-9+(])(?:(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
         r"|\+1[ .-]?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-]?)[2-9][0-9]{2}[ .-]?[0-9]{4})(?![0-9])")
# With +1 or brackets any area and exchange will do, and with +1 no separators are needed. FOREIGN also has those with +1 and an area
# below 200, LOOSE the others.
FOREIGN = (r"(?<![0-9+])(?:\+[2-9](?:[ .()-]{0,2}[0-9]){8,13}"
           r"|\+1[ .-]?(?:\([01][0-9]{2}\) ?|[01][0-9]{2}[ .-]?)[0-9]{3}[ .-]?[0-9]{4})(?![0-9])")
LOOSE = (r"(?<![0-9+(])(?:\+1[ .-]?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-]?)[01][0-9]{2}[ .-]?"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-])[0-9]{4}(?![0-9])")
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
ANY = "|".join((EMAIL, IP, ISO_DATE, DAY_DATE, SSN, PHONE, FOREIGN, LOOSE, CARD))


def _q(s: str) -> str:
    """A raw SQL string literal (the patterns hold no quote)."""
    return "r'" + s + "'"


def feistel(values: str, radices: str, kind: str, key: str) -> str:
    """SQL for the permuted list; ``values`` and ``radices`` are SQL arrays of one length."""
    half = "(size(vs) div 2)"
    other = f"array_join(transform(filter(acc, (y, j) -> (j < {half}) = (rnd % 2 = 1)), y -> string(y)), ',')"
    add = f"conv(substr(sha2(concat_ws('|', {key}, '{kind}', string(rnd), string(i), {other}), 256), 1, 13), 16, 10)"
    return (f"aggregate(array(named_struct('vs', {values}, 'rs', {radices})), cast(array() as array<bigint>), (none, s) -> "
            f"aggregate(sequence(0, {ROUNDS - 1}), s.vs, (acc, rnd) -> transform(acc, (x, i) -> "
            f"if((i < {half.replace('vs', 's.vs')}) = (rnd % 2 = 0), (x + cast({add.replace('size(vs)', 'size(s.vs)')} as bigint)) % s.rs[i], x))))")


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced one by one by those of the string ``digits``."""
    return (f"aggregate({_chars(text)}, named_struct('out', '', 'i', 0, 'd', {digits}), (s, c) -> "
            f"if(c rlike '[0-9]', named_struct('out', concat(s.out, substr(s.d, s.i + 1, 1)), 'i', s.i + 1, 'd', s.d), "
            f"named_struct('out', concat(s.out, c), 'i', s.i, 'd', s.d)), s -> s.out)")


def _number(digits: str, start: int, n: int) -> str:
    return f"cast(substr({digits}, {start}, {n}) as bigint)"


def _pad(value: str, n: int) -> str:
    return f"lpad(string({value}), {n}, '0')"


def _bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _card(m: str, key: str) -> str:
    """First digit kept, payload permuted, Luhn digit made anew; null if no number is valid.

    The number is the longest valid run of whole groups (the first of equal
    ones), so a date or code before or after a card does not hide it.
    """
    n = "length(w.d)"
    payload = f"transform({_chars(f'substr(w.d, 2, {n} - 2)')}, c -> cast(c as bigint))"
    permuted = f"concat(substr(w.d, 1, 1), array_join({feistel(payload, f'array_repeat(cast(10 as bigint), {n} - 2)', 'card', key)}, ''))"
    # Every second digit from the right, starting with the last of the payload, counts double.
    weigh = "if((length(p) - i) % 2 = 1, if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)), int(c))"
    check = f"(10 - aggregate(transform({_chars('p')}, (c, i) -> {weigh}), 0, (a, x) -> a + x) % 10) % 10"
    whole = _bind(permuted, "p", f"concat(p, string({check}))")
    at = f"sequence(1, length({m}))"
    begins = f"filter({at}, k -> k = 1 or substr({m}, k - 1, 1) in (' ', '-'))"
    ends = f"filter({at}, k -> k = length({m}) or substr({m}, k + 1, 1) in (' ', '-'))"
    run = _digits(f"substr({m}, b, e - b + 1)")
    runs = f"flatten(transform({begins}, b -> transform(filter({ends}, e -> e >= b + 12), e -> named_struct('n', -length({run}), 'b', b, 'e', e, 'd', {run}))))"
    valid = "-r.n between 13 and 19 and luhn_check(r.d) and r.d rlike '[1-9]'"
    new = f"concat(substr({m}, 1, w.b - 1), {_refill(f'substr({m}, w.b, w.e - w.b + 1)', whole)}, substr({m}, w.e + 1))"
    return _bind(f"array_min(filter({runs}, r -> {valid}))", "w", f"if(w is null, null, {new})")


def _phone(m: str, key: str) -> str:
    """Area, exchange and line permuted together (both codes stay 200 to 999); the country code stays."""
    values = f"array({_number('t', 1, 3)} - 200, {_number('t', 4, 3)} - 200, {_number('t', 7, 4)})"
    f = feistel(values, "array(800L, 800L, 10000L)", "phone", key)
    new = _bind(f, "v", f"concat({_pad('v[0] + 200', 3)}, {_pad('v[1] + 200', 3)}, {_pad('v[2]', 4)})")
    return _bind(_digits(m), "d", _bind("right(d, 10)", "t", _refill(m, f"concat(left(d, length(d) - 10), {new})")))


def _foreign(m: str, key: str) -> str:
    """All digits after the first two of an international number are permuted."""
    rest = f"transform({_chars('substr(d, 3)')}, c -> cast(c as bigint))"
    f = feistel(rest, "array_repeat(cast(10 as bigint), length(d) - 2)", "phone", key)
    return _bind(_digits(m), "d", _refill(m, f"concat(left(d, 2), array_join({f}, ''))"))


def _loose(m: str, key: str) -> str:
    """Below area 200 all digits after the area's first, as with +1; else area (200 to 999), exchange (0 to 199) and line.

    Either way the pseudonym is again one that ``_phone`` never makes.
    """
    low = feistel(f"transform({_chars('substr(t, 2)')}, c -> cast(c as bigint))", "array_repeat(cast(10 as bigint), 9)", "phone", key)
    high = feistel(f"array({_number('t', 1, 3)} - 200, {_number('t', 4, 3)}, {_number('t', 7, 4)})", "array(800L, 200L, 10000L)", "phone", key)
    high = _bind(high, "v", f"concat({_pad('v[0] + 200', 3)}, {_pad('v[1]', 3)}, {_pad('v[2]', 4)})")
    new = f"if(t < '2', concat(left(t, 1), array_join({low}, '')), {high})"
    return _bind(_digits(m), "d", _bind("right(d, 10)", "t", _refill(m, f"concat(left(d, length(d) - 10), {new})")))


def _ip(m: str, key: str) -> str:
    octets = f"transform(split({m}, '[.]'), x -> cast(x as bigint))"
    f = feistel("v", "array_repeat(cast(256 as bigint), 4)", "ip", key)
    return _bind(octets, "v", f"if(forall(v, x -> x < 256), array_join({f}, '.'), null)")


def _ssn(m: str, key: str) -> str:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    area, group, serial = _number("d", 1, 3), _number("d", 4, 2), _number("d", 6, 4)
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    values = f"array(if({area} > 666, {area} - 2, {area} - 1), {group} - 1, {serial} - 1)"
    f = feistel(values, "array(898L, 99L, 9999L)", "ssn", key)
    new = _bind(f, "v", f"concat_ws('-', {_pad('if(v[0] >= 665, v[0] + 2, v[0] + 1)', 3)}, {_pad('v[1] + 1', 2)}, {_pad('v[2] + 1', 4)})")
    return _bind(_digits(m), "d", f"if({valid}, {new}, null)")


def _date(m: str, pattern: str, key: str) -> str:
    """A day of the years 1800 to 2199 for another; the same day in another format gets the same day."""
    day = f"try_to_timestamp({m}, '{pattern}')"
    n = "datediff(t, date'1800-01-01')"
    f = feistel(f"array(cast({n} div 773 as bigint), cast({n} % 773 as bigint))", "array(189L, 773L)", "date", key)
    new = _bind(f, "v", f"date_format(date_add(date'1800-01-01', int(v[0] * 773 + v[1])), '{pattern}')")
    return _bind(f"cast({day} as date)", "t", f"if(t between date'1800-01-01' and date'2199-12-31', {new}, null)")


def _email(m: str, key: str) -> str:
    """Letters and digits of the mail box change within their class; its signs and the domain stay.

    A box of more than ``MAX_BOX`` characters, or a domain of more than ``MAX_DOMAIN``, is no address.
    """
    box, rest = f"substring_index({m}, '@', 1)", f"substr({m}, instr({m}, '@'))"
    base = "case when c rlike '[a-z]' then 97 when c rlike '[A-Z]' then 65 when c rlike '[0-9]' then 48 else ascii(c) end"
    radix = "case when c rlike '[A-Za-z]' then 26L when c rlike '[0-9]' then 10L else 1L end"
    cs = _chars(box)
    f = feistel(f"transform(cs, c -> cast(ascii(c) - ({base}) as bigint))", f"transform(cs, c -> {radix})", "email", key)
    new = _bind(f, "v", f"array_join(transform(cs, (c, i) -> char(({base}) + v[i])), '')")
    valid = f"instr({m}, '@') <= {MAX_BOX} + 1 and length({m}) - instr({m}, '@') <= {MAX_DOMAIN}"
    return f"if({valid}, {_bind(cs, 'cs', f'concat({new}, {rest})')}, null)"


def _replace(m: str, key: str) -> str:
    """SQL struct of kind and pseudonym (both null if nothing is valid) for the candidate ``m``."""
    def whole(p):
        return f"{m} rlike {_q('^(?:' + p + ')$')}"
    kind = (f"case when contains({m}, '@') then 'email' when {whole(IP)} then 'ip' when {whole(ISO_DATE)} or {whole(DAY_DATE)} then 'date' "
            f"when {whole(SSN)} then 'ssn' when {whole(PHONE)} or {whole(FOREIGN)} or {whole(LOOSE)} then 'phone' else 'card' end")
    # A date with dots or slashes is read day first, else month first.
    dated = ", ".join(f"if({whole(shape)}, {_date(m, pattern, key)}, null)" for shape, pattern in (
        ("[0-9]{4}-.*", "yyyy-MM-dd"), (r"..\...\.....", "dd.MM.yyyy"), ("../../....", "dd/MM/yyyy"), ("../../....", "MM/dd/yyyy")))
    new = (f"case k when 'email' then {_email(m, key)} when 'ip' then {_ip(m, key)} when 'date' then coalesce({dated}) "
           f"when 'ssn' then {_ssn(m, key)} when 'phone' then if({whole(PHONE)}, {_phone(m, key)}, if({whole(FOREIGN)}, {_foreign(m, key)}, {_loose(m, key)})) else {_card(m, key)} end")
    return _bind(kind, "k", _bind(new, "p", "named_struct('kind', if(p is null, null, k), 'value', coalesce(p, " + m + "))"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", kinds_col: str = "pii") -> DataFrame:
    """``docs`` with ``text_col`` rewritten, and ``kinds_col`` (an array of the kinds replaced, in order).

    ``kinds_col`` replaces a column of that name; other columns stay as they are.
    A null text stays null and has null kinds; an empty or very long text is
    handled as any other; repeated rows come out alike. Candidates that are not
    valid stay as they are. ``key`` is the secret: the same key gives the same
    pseudonyms in every table.
    """
    secret = "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'"
    # Numbered names: a caller's column may be called anything.
    names = [c for c in docs.columns if c != kinds_col]
    plain = docs.toDF(*[f"_k{i}" if c != kinds_col else "_old" for i, c in enumerate(docs.columns)]).drop("_old")
    kept, text = plain.columns, plain.columns[names.index(text_col)]
    # Only texts with a digit or a mail sign are searched.
    hot = f"({text} rlike '[0-9@]')"
    cut = plain.select(*kept, F.expr(f"if({hot}, regexp_extract_all({text}, {_q(ANY)}, 0), cast(array() as array<string>))").alias("_found"))
    new = cut.select(*kept, F.expr(f"transform(_found, m -> {_replace('m', secret)})").alias("_new"))
    rest = new.select(*kept, "_new", F.expr(f"if(size(_new) > 0, split({text}, {_q(ANY)}, -1), cast(array() as array<string>))").alias("_rest"))
    filled = F.expr(f"if(size(_new) > 0, concat(array_join(zip_with(slice(_rest, 1, size(_new)), _new, (a, b) -> concat(a, b.value)), ''), "
                    f"element_at(_rest, -1)), {text})")
    return rest.select(*[(filled if k == text else F.col(k)).alias(c) for k, c in zip(kept, names)],
                       F.expr("filter(transform(_new, x -> x.kind), k -> k is not null)").alias(kinds_col))
