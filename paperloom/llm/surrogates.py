"""Personal data replaced by keyed surrogates of the same type and format.

One pattern finds addresses, numbers, secrets and titled names. Each entity has a
normal form (digits alone, lower case, single name words), and a keyed permutation
of all normal forms of the same shape gives its surrogate: digits for digits,
letters of the same script and case for letters, octets for octets, a card or
account number that passes its check if and only if the original does, a surname
of syllables of its script. The permutation is a Feistel network whose rounds add
a keyed digest of one half of the characters to the other, each modulo its own
alphabet, so different entities never get the same surrogate, however many there
are, and equal ones get equal surrogates everywhere, in whatever format they
stand. A surrogate may by chance be another real entity, as any plausible one may:
where all forms of a shape are taken, nothing else is left.

Given names come from fixed lists by gender and script. This is where surrogates
can collide, so it is checked over the whole corpus: of the names that draw the same
list name the least keeps it, unless it is itself a real name there; all others are
widened by the syllables of their own permutation, which makes them distinct. At most
one row for each list name reaches the driver, and no text is ever shuffled.

Coreference: a given name has one surrogate in a text, whatever titles it stands
with; its gender is that of the lists, else of a title in the same text, else open.
Words of a titled name that stand alone in the same text are replaced alike.

Main path: DataFrame functions only. Edge cases: a null text stays null; an empty
one stays empty; a text without entities stays as it is, byte for byte; repeated
rows are replaced alike; equal entities are one, so there are no ties but those of
list names, which the least name wins; an entity of any length is replaced whole; an
empty table gives an empty result. Characters of no known alphabet stay. Four
numbers after a word such as version, or of one digit each, are no address.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: The key over the standard synthetic tables. Real ones need a secret: with the key, surrogates can be turned back.
SYNTHETIC_KEY = "synthetic tables"

# Titles by gender.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа")
OTHER_TITLES = ("Dr", "Prof", "Professor")
# Given names by gender and script.
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leon", "Marco", "Noel", "Oscar", "Paul"),
    ("f", "latin"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura", "Maria", "Nina", "Olga", "Paula"),
    ("x", "latin"): ("Alex", "Bobbie", "Charlie", "Dana", "Eden", "Frankie", "Gabi", "Hayden", "Indigo", "Jamie", "Kim", "Lane", "Morgan", "Noa", "Quinn", "Robin"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан"),
    ("f", "cyrillic"): ("Анна", "Белла", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Ирина", "Ксения", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София"),
    ("x", "cyrillic"): ("Саша", "Женя", "Валя", "Слава", "Паша", "Тоня", "Юля", "Стася", "Вася", "Миша", "Рома", "Лёня", "Гоша", "Митя", "Ася", "Тася"),
}
#: Syllables of made-up names: a consonant and a vowel for each letter, by script; even and odd places take other vowels.
SYLLABLES = {"latin": ("bdfgklmnprstv", "ao", "ei"), "cyrillic": ("бвгджзклмнпрстфх", "ао", "еи")}
# First code point and size of alphabets.
ALPHABETS = (
    (0x30, 10), (0x41, 26), (0x61, 26), (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x391, 17), (0x3A3, 7), (0x3B1, 25), (0x410, 32), (0x430, 32),
    (0x5D0, 27), (0x621, 26), (0x904, 54), (0xE01, 46), (0x3041, 86), (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
)
ROUNDS = 4

_W = r"\p{L}\p{N}"
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_TITLES = sorted((*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES), key=len, reverse=True)
_CAPITALS = "".join(sorted({t[0] for t in _TITLES}))
_TITLED = f"(?=[{_CAPITALS}])(?:{'|'.join(_TITLES)})"
_ASSIGNED = r"""(?=[tspabTSPAB])(?<![\p{L}\p{N}])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|bearer)["']?\s{0,3}[=:]\s{0,3}["']?"""
#: Type and pattern, the first that fits at a place wins. Each begins with a cheap test of
#: one character, and starts are pinned, so a long run of characters is tried once.
PATTERNS = (
    ("secret", rf"{_ASSIGNED}[A-Za-z0-9+/_-]{{16,}}+={{0,2}}"),
    ("email", rf"(?<![{_W}._%+-])[{_W}._%+-]++@[{_W}-]++(?:\.[{_W}-]++)+"),
    ("ip", r"(?=\d)(?<![\d.])(?<![vV])(?<!(?i:version|release|build|ver|rev)[ .:]{0,2})(?!\d(?:\.\d){3}(?!\d))(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"),
    ("iban", rf"(?=[A-Z])(?<![{_W}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_W}])"),
    ("phone", r"(?=[+(\d])(?:(?<![\d+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d))"),
    ("ssn", r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", rf"(?=\d)(?<![{_W}-])\d(?:[ -]?\d){{12,18}}+(?![{_W}])"),
    ("hex", rf"(?=[0-9a-f])(?<![{_W}])(?=[0-9a-f]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{{32,128}}(?![{_W}])"),
    ("name", rf"(?=[{_CAPITALS}])(?<![{_W}])(?:{'|'.join(_TITLES)})\.?\s{_NAME}(?:\s{_NAME}){{0,2}}"),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: A text without this has no entity.
HINT = rf"[@\d]|{_TITLED}[.\s]"
#: Nor has one without this a name.
TITLE_HINT = rf"{_TITLED}[.\s]"
DIGIT_TYPES = ("card", "phone", "ssn")
_MADE = "array<struct<type:string,surrogate:string>>"


def _is(value: Column, *types: str) -> Column:
    return value.isin(*types)


def entity_type(match: Column) -> Column:
    """The type of a match: the first pattern that fits all of it."""
    out = F.lit("secret")
    for name, pattern in reversed(PATTERNS[1:]):
        out = F.when(match.rlike(rf"^(?:{pattern})$"), name).otherwise(out)
    return F.when(match.rlike(rf"^(?:{PATTERNS[0][1]})$"), "secret").otherwise(out)


def _gender(match: Column) -> Column:
    title = F.regexp_extract(match, r"^[^\s.]+", 0)
    return F.when(title.isin(*MALE_TITLES), "m").when(title.isin(*FEMALE_TITLES), "f").otherwise("x")


def _prefix(kind: Column, match: Column) -> Column:
    """What of a match stays before the entity: the word that announces a secret, a title."""
    return F.when(kind == "secret", F.regexp_extract(match, f"^{_ASSIGNED}", 0)).when(kind == "name", F.regexp_extract(match, r"^[^\s.]+\.?\s", 0)).otherwise("")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def name_words(match: Column) -> Column:
    """The words of a titled name, without the title."""
    return F.filter(F.split(F.regexp_replace(match, r"^[^\s.]+\.?\s", ""), r"\s"), lambda w: w != "")


def _known(word: Column, gender: str) -> Column:
    return word.isin(*(n for (g, _), names in GIVEN.items() if g == gender for n in names))


def name_parts(matches: Column) -> Column:
    """``array<struct<word, type>>`` of a text's titled names, each word once: surname or given with its gender."""
    names = F.filter(matches, lambda m: m["type"] == "name")
    words = lambda m: name_words(m["match"])
    givens = lambda m: _let(words(m), lambda ws: F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0))))
    with_title = lambda ns, g: F.flatten(F.transform(F.filter(ns, lambda m: _gender(m["match"]) == g), givens))

    def of(ns, men, women):
        gender = lambda w: F.when(_known(w, "m"), "m").when(_known(w, "f"), "f").when(F.array_contains(men, w), "m").when(F.array_contains(women, w), "f").otherwise("x")
        first = F.transform(F.array_distinct(F.flatten(F.transform(ns, givens))), lambda w: F.struct(w.alias("word"), F.concat(F.lit("given:"), gender(w)).alias("type")))
        last = F.transform(F.array_distinct(F.flatten(F.transform(ns, lambda m: F.slice(words(m), -1, 1)))), lambda w: F.struct(w.alias("word"), F.lit("surname").alias("type")))
        return F.concat(first, F.filter(last, lambda x: ~F.exists(first, lambda y: y["word"] == x["word"])))

    return _let(names, lambda ns: _let(with_title(ns, "m"), lambda men: _let(with_title(ns, "f"), lambda women: of(ns, men, women))))


def norm_of(kind: Column, match: Column) -> Column:
    """The normal form of what is no name."""
    return F.when(_is(kind, *DIGIT_TYPES), F.regexp_replace(match, r"\D", "")).when(kind == "email", F.lower(match)).when(kind == "iban", F.replace(match, F.lit(" "), F.lit(""))).when(kind == "secret", F.substr(match, F.length(_prefix(kind, match)) + 1)).otherwise(match)


def _hex_int(h: Column, at: Column, n: int) -> Column:
    return F.conv(F.substr(h, at, F.lit(n)), 16, 10).cast("int")


def permuted(values: Column, sizes: Column, kind: Column, key: str) -> Column:
    """A keyed permutation of arrays ``values``, place i modulo ``sizes[i]``; ``kind`` and sizes choose which."""
    tweak = F.concat_ws("\u0001", F.lit(key), kind, F.array_join(F.transform(sizes, lambda n: n.cast("string")), ","))

    def turn(vs, ns, tw, half, r):
        lo, n = (half, F.size(vs) - half) if r % 2 == 0 else (F.lit(0), half)
        other = F.array_join(F.transform(F.slice(vs, F.lit(1) if r % 2 == 0 else half + 1, half if r % 2 == 0 else F.size(vs) - half), lambda x: x.cast("string")), ",")
        digest = lambda o: F.array_join(F.transform(F.sequence(F.lit(0), (F.size(vs) / 32).cast("int")), lambda b: F.sha2(F.concat_ws("\u0001", tw, F.lit(str(r)), b.cast("string"), o).cast("binary"), 512)), "")
        put = lambda h: F.transform(vs, lambda x, i: F.when((i >= lo) & (i < lo + n), F.pmod(x + _hex_int(h, i * 4 + 1, 4), F.get(ns, i))).otherwise(x))
        return _let(other, lambda o: _let(digest(o), put))

    def rounds(vs, ns, tw, half, r=0):
        return vs if r == ROUNDS else _let(turn(vs, ns, tw, half, r), lambda now: rounds(now, ns, tw, half, r + 1))

    return _let(values, lambda vs: _let(sizes, lambda ns: _let(tweak, lambda tw: _let((F.size(vs) / 2).cast("int"), lambda half: rounds(vs, ns, tw, half)))))


def _in_alphabet(code: Column, of_known, otherwise) -> Column:
    """``of_known(first, size)`` of the alphabet that holds a code point."""
    out = None
    for first, size in ALPHABETS:
        hit = code.between(first, first + size - 1)
        out = F.when(hit, of_known(first, size)) if out is None else out.when(hit, of_known(first, size))
    return out.otherwise(otherwise)


def _character(code: Column) -> Column:
    return F.when(code < 128, F.chr(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _codes(value: Column) -> Column:
    return F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.ascii(c))


def shaped_codes(kind: Column, value: Column, key: str, made) -> Column:
    """``made(codes)`` of the code points of a text permuted within their alphabets; others stay."""

    def of(codes):
        firsts = F.transform(codes, lambda c: _in_alphabet(c, lambda lo, n: F.lit(lo), c))
        sizes = F.transform(codes, lambda c: _in_alphabet(c, lambda lo, n: F.lit(n), F.lit(1)))
        return _let(firsts, lambda lo: _let(permuted(F.zip_with(codes, lo, lambda c, f: c - f), sizes, F.concat_ws(",", kind, F.array_join(F.transform(lo, lambda x: x.cast("string")), ",")), key), lambda vs: made(F.zip_with(vs, lo, lambda v, f: v + f))))

    return _let(_codes(value), of)


def shaped(kind: Column, value: Column, key: str) -> Column:
    """Digits for digits, letters for letters of the same case and script; other characters stay."""
    return shaped_codes(kind, value, key, lambda codes: F.array_join(F.transform(codes, _character), ""))


def syllables(kind: Column, word: Column, key: str) -> Column:
    """A made-up name: a syllable for each permuted letter, other characters as they are permuted."""

    def one(code, i):
        out = _character(code)
        for (consonants, even, odd), first, n in ((SYLLABLES["latin"], 0x61, 26), (SYLLABLES["cyrillic"], 0x430, 32)):
            at, vowel = (code - first).cast("int"), F.when(i % 2 == 0, F.substr(F.lit(even), F.pmod(code - first, F.lit(2)) + 1, F.lit(1))).otherwise(F.substr(F.lit(odd), F.pmod(code - first, F.lit(2)) + 1, F.lit(1)))
            out = F.when(code.between(first, first + n - 1), F.concat(F.substr(F.lit(consonants), (at / 2).cast("int") + 1, F.lit(1)), vowel)).otherwise(out)
        return out

    made = shaped_codes(kind, F.lower(word), key, lambda codes: F.array_join(F.transform(codes, one), ""))
    return _let(made, lambda m: F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(m)).otherwise(F.concat(F.upper(F.substring(m, 1, 1)), F.substr(m, F.lit(2)))))


def _luhn(digits: Column) -> Column:
    """The check sum of a digit string, from the right."""
    each = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)), F.lit(10))


def _card(norm: Column, key: str) -> Column:
    """As many digits, the first as it was; the check digit is off by as much as it was."""
    due = lambda body: F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    body = F.substr(norm, F.lit(1), F.length(norm) - 1)
    off = F.substring(norm, -1, 1).cast("int") - due(body)
    return _let(F.concat(F.substring(norm, 1, 1), shaped(F.lit("card"), F.substr(norm, F.lit(2), F.length(norm) - 2), key)), lambda b: F.concat(b, F.pmod(due(b) + off, F.lit(10)).cast("string")))


def _account(norm: Column, key: str) -> Column:
    """The country as it was; the check number is off by as much as it was."""
    value = lambda c: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string"))
    digits = lambda b: F.split(F.array_join(F.transform(F.filter(F.split(F.concat(b, F.substring(norm, 1, 2), F.lit("00")), ""), lambda c: c != ""), value), ""), "")
    due = lambda b: 98 - F.aggregate(F.filter(digits(b), lambda c: c != ""), F.lit(0), lambda a, d: F.pmod(a * 10 + d.cast("int"), F.lit(97)))
    off = F.substring(norm, 3, 2).cast("int") - due(F.substr(norm, F.lit(5)))
    return _let(shaped(F.concat(F.lit("iban"), F.substring(norm, 1, 2)), F.substr(norm, F.lit(5)), key), lambda b: F.concat(F.substring(norm, 1, 2), F.lpad(F.pmod(due(b) + off, F.lit(100)).cast("string"), 2, "0"), b))


def surrogate(kind: Column, norm: Column, key: str) -> Column:
    """The surrogate of a normal form that is no name."""
    octets = F.transform(F.split(norm, r"\."), lambda x: x.cast("int"))
    places = lambda n, size: F.transform(n, lambda _: F.lit(size))
    nibbles = F.transform(F.filter(F.split(norm, ""), lambda c: c != ""), lambda c: F.conv(c, 16, 10).cast("int"))
    return (
        F.when(kind == "card", _card(norm, key)).when(_is(kind, *DIGIT_TYPES), F.concat(F.substring(norm, 1, 1), shaped(kind, F.substr(norm, F.lit(2)), key)))
        .when(kind == "ip", _let(octets, lambda o: F.array_join(F.transform(permuted(o, places(o, 256), kind, key), lambda x: x.cast("string")), ".")))
        .when(norm.rlike("^[0-9a-f]+$"), _let(nibbles, lambda v: F.array_join(F.transform(permuted(v, places(v, 16), kind, key), lambda x: F.lower(F.hex(x))), "")))
        .when(kind == "email", F.concat(shaped(F.lit("email"), F.regexp_extract(norm, r"^(.*)\.", 1), key), F.lit("."), F.substring_index(norm, ".", -1)))
        .when(kind == "iban", _account(norm, key))
        .otherwise(shaped(kind, norm, key))
    )


def listed(kind: Column, word: Column, key: str) -> Column:
    """The list name that a given name draws."""
    nibble = F.conv(F.substring(F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("given"), F.lower(word)).cast("binary"), 256), 1, 1), 16, 10).cast("int")
    out = None
    for (gender, script), names in GIVEN.items():
        hit = (kind == f"given:{gender}") & (word.rlike(r"^\p{IsCyrillic}") if script == "cyrillic" else ~word.rlike(r"^\p{IsCyrillic}"))
        made = F.element_at(F.array(*(F.lit(n) for n in names)), nibble + 1)
        out = F.when(hit, made) if out is None else out.when(hit, made)
    return out


def name_surrogate(kind: Column, word: Column, winners: Column, key: str) -> Column:
    """The surrogate of a name's word. winners: who keeps a list name, in lower case."""
    as_written = lambda made: F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(made)).otherwise(made)
    given = _let(listed(kind, word, key), lambda n: F.when(F.try_element_at(winners, n) == F.lower(word), as_written(n)).otherwise(F.concat(as_written(n), F.lit("-"), syllables(F.lit("given"), word, key))))
    return F.when(kind == "surname", syllables(kind, word, key)).otherwise(given)


def _formatted(match: Column, made: Column) -> Column:
    """The surrogate's characters in the places of the match's letters and digits."""
    count = lambda i: F.length(F.regexp_replace(F.substr(match, F.lit(1), i + 1), f"[^{_W}]", ""))
    return F.array_join(F.transform(F.split(match, ""), lambda c, i: F.when(c.rlike(f"^[{_W}]$"), F.substr(made, count(i), F.lit(1))).otherwise(c)), "")


def replacement(kind: Column, match: Column, names: Column, key: str) -> Column:
    """What stands in a match's place. names: ``map<word, surrogate>`` of the text's names."""
    named = F.concat(_prefix(kind, match), F.array_join(F.transform(name_words(match), lambda w: F.try_element_at(names, w)), " "))
    other = _let(surrogate(kind, norm_of(kind, match), key), lambda made: F.concat(_prefix(kind, match), F.when(_is(kind, *DIGIT_TYPES, "iban"), _formatted(match, made)).otherwise(made)))
    return F.when(kind == "name", named).otherwise(other)


def found(text: Column) -> Column:
    """``array<struct<match, type>>`` of a text's entities in order."""
    none = F.array().cast("array<struct<match:string,type:string>>")
    return F.when(text.rlike(HINT), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("match"), entity_type(m).alias("type")))).otherwise(none)


def winners(docs: DataFrame, key: str) -> dict[str, str]:
    """Which given name (in lower case) of a table with ``matches`` keeps each list name: at most one for each.

    This is the check for collisions over the whole corpus. A list name that is a real name somewhere is nobody's.
    """
    names = docs.filter(F.exists("matches", lambda m: m["type"] == "name")).select(F.explode(F.filter(name_parts(F.col("matches")), lambda p: p["type"] != "surname")).alias("p"))
    words = names.select(F.col("p.type").alias("type"), F.col("p.word").alias("word"))
    least = words.groupBy(listed(F.col("type"), F.col("word"), key).alias("made")).agg(F.min(F.lower("word")).alias("norm")).collect()
    fixed = [n.lower() for v in GIVEN.values() for n in v]
    real = {r["w"] for r in words.select(F.lower("word").alias("w")).filter(F.col("w").isin(*fixed)).distinct().collect()}
    return {r["made"]: r["norm"] for r in least if r["made"].lower() not in real}


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_entities, entities`` for every row of ``docs``; entities: their types and surrogates in order."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("matches", found(F.col("text")))
    titled = docs.filter(F.col("text").rlike(TITLE_HINT))
    held = winners(titled, key)
    keeps = F.create_map(*(F.lit(x) for kv in sorted(held.items()) for x in kv)) if held else F.create_map().cast("map<string,string>")
    none = F.create_map().cast("map<string,string>")
    named = F.map_from_entries(F.transform(name_parts(F.col("matches")), lambda p: F.struct(p["word"], name_surrogate(p["type"], p["word"], keeps, key))))
    docs = docs.withColumn("names", F.when(F.exists("matches", lambda m: m["type"] == "name"), named).otherwise(none))
    made = F.transform("matches", lambda m: F.struct(m["type"].alias("type"), replacement(m["type"], m["match"], F.col("names"), key).alias("surrogate")))
    docs = docs.withColumn("made", F.when(F.size("matches") > 0, made).otherwise(F.array().cast(_MADE)))

    # between the matches: words of the text's names that stand alone
    alone = F.concat(F.lit(f"(?<![{_W}])(?:"), F.array_join(F.transform(F.map_keys("names"), lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "|"), F.lit(f")(?![{_W}])"))
    hits = lambda gap: F.regexp_extract_all(gap, alone, F.lit(0))
    gaps = F.transform(F.split("text", ANY, -1), lambda gap: F.struct(gap.alias("gap"), F.when(F.size("names") > 0, hits(gap)).otherwise(F.array().cast("array<string>")).alias("hits")))
    docs = docs.withColumn("gaps", F.when(F.size("matches") > 0, gaps).otherwise(F.array().cast("array<struct<gap:string,hits:array<string>>>")))
    stitched = lambda g: F.when(F.size(g["hits"]) == 0, g["gap"]).otherwise(F.array_join(F.zip_with(F.split(g["gap"], alone, -1), F.concat(F.transform(g["hits"], lambda w: F.try_element_at(F.col("names"), w)), F.array(F.lit(""))), lambda x, y: F.concat(x, y)), ""))
    joined = F.array_join(F.zip_with(F.transform("gaps", stitched), F.concat(F.col("made.surrogate"), F.array(F.lit(""))), lambda g, s: F.concat(g, s)), "")
    of_gap = lambda g: F.transform(g["hits"], lambda w: F.struct(F.lit("name").alias("type"), F.try_element_at(F.col("names"), w).alias("surrogate")))
    entities = F.flatten(F.zip_with("gaps", "made", lambda g, m: F.concat(F.when(g.isNull(), F.array().cast(_MADE)).otherwise(of_gap(g)), F.when(m.isNull(), F.array().cast(_MADE)).otherwise(F.array(m)))))
    return docs.select("doc_id", F.when(F.size("matches") > 0, joined).otherwise(F.col("text")).alias("text"), entities.alias("entities")).select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def query(spark, sf_dir: str) -> DataFrame:
    got = replace(table(spark, sf_dir, "documents"), SYNTHETIC_KEY)
    return got.select("doc_id", "text", "n_entities", F.concat_ws(",", "entities.type").alias("types"))
