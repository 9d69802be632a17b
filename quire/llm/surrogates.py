"""PII surrogates (operator 9), with DataFrame and SQL functions only.

One pattern finds e-mail addresses, IPv4 addresses, phone, card, IBAN and social security numbers, and names after a title, in one pass
over each text. Each entity is replaced by a keyed surrogate of its type. Characters keep their class (digit, lower or upper case, and
script), so formats stay: a four-round keyed Feistel cipher over the characters shifts each half by a stream that the other half and the
key determine. It is a bijection on strings of one format, so different entities get different surrogates and equal ones the same, in
every document, without a table. Address bytes are enciphered as one 32-bit number; card numbers keep their first digit and what the
check digit says. An e-mail address keeps its last domain part.

A name after a title becomes a made-up surname in its own script, which the surname and the key alone determine, so that "Mr John
Smith", "Mr Smith" and "Dr Smith" share it, and a given name of the person's gender where there was one, which both names determine. The
title tells the gender; Dr and Prof do not, there the given name does (names in -a count as female). A possessive ending is not part of
a name. Names count after a title of the list only, written in Latin, Greek or Cyrillic letters; other scripts get Latin letters.

Only made-up names can meet: a check over all entities finds different ones with equal surrogates, and surrogates that are entities of
the corpus themselves, and gives those another attempt until none is left, whatever their number: they are a written table, which is
joined to the texts where it is too large to become part of the query. Later attempts at names and e-mail addresses draw from larger
sets. Where the entities fill more than a quarter of all strings of their format, a surrogate may be another entity of the corpus (the
bijection still keeps them distinct); e-mail addresses are never treated so.

Defined results: null text stays null and empty text stays empty, with no entities; very long texts are searched whole; numbers that
fail the card check, versions, other bare numbers and numbers after a plus of fewer than seven digits are left alone; where two kinds
could begin at one place, the first of KINDS counts; repeated rows each give a row with equal results, and ids are never looked at;
extra columns are dropped, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.shared import stored

KINDS = ("email", "ip", "iban", "ssn", "phone", "card", "name")
#: Entities that need another attempt, at most, to become part of the query; more are joined to the texts.
MOST_EXCEPTIONS = 2_000
#: From this attempt on, names and e-mail addresses come from larger sets.
_ATTEMPTS = 8
#: Digits of an international phone number, at least.
_PHONE_DIGITS = 7

#: Titles by gender (u: the given name tells it), and given names that surrogates take, by script and gender.
TITLES = {
    "m": "Mr Herr Monsieur Señor Don Sir Lord Господин господин Κύριος κύριος",
    "f": "Mrs Ms Miss Frau Madame Mademoiselle Señora Señorita Doña Lady Госпожа госпожа Κυρία κυρία",
    "x": "Mx",
    "u": "Dr Prof",
}
GIVEN = {
    "latin": {
        "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Marco Nils Oscar Paul Rafael Simon Tomas Victor",
        "f": "Ada Bella Clara Diana Elsa Flora Greta Helena Ida Julia Klara Laura Maria Nora Olga Paula Rosa Sara Teresa Vera",
        "x": "Alex Bobbie Casey Dana Eden Frankie Gale Harper Indigo Jamie Kai Lee Morgan Nico Oakley Parker Quinn Robin Sasha Toni",
    },
    "cyrillic": {
        "m": "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Олег Павел Роман Семён Тимур",
        "f": "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Раиса Софья",
        "x": "Женя Саша Валя Шура",
    },
    "greek": {
        "m": "Αλέξης Γιάννης Δημήτρης Ηλίας Θωμάς Κώστας Λάμπρος Μάριος Νίκος Πέτρος Σταύρος Φώτης",
        "f": "Αθηνά Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Λυδία Μαρία Νεφέλη Σοφία",
        "x": "Αλεξία Χαρά",
    },
}
#: The alphabets whose letters stand for each other.
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "àáâãäåçèéêëìíîïñòóôõöøùúûüýßœæ", "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒÆ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
)
_SYLLABLES = [c + v for c in "bdfgklmnprstvz" for v in "aeiou"]
_SYLLABLES_OF = {"cyrillic": [c + v for c in "бвгдзклмнпрстфх" for v in "аеиоу"], "greek": [c + v for c in "βγδζκλμνπρστφχ" for v in "αειοω"]}
#: What a name of a script surely holds.
_SCRIPTS = {"cyrillic": "[а-яёА-ЯЁ]", "greek": "[α-ωΑ-Ω]"}
#: Stands around matches while a text is cut; texts that hold it themselves are cut in two passes.
_MARK = "\ufdd0"

_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(t for g in TITLES.values() for t in g.split())
_NAME = r"\p{Lu}(?:\p{L}|-\p{L}|['’]\p{Lu})+"
#: One pattern for each kind; a match's kind is the first whose whole pattern it matches.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+(?<![\-])",
    "ip": rf"(?<![\w.]){_BYTE}(?:\.{_BYTE}){{3}}(?!\w|\.\d)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}|\(\d{2,4}\) ?\d{3,4}[ .\-]\d{3,4}|\d{3}[.\-]\d{3}[.\-]\d{4})(?!\w)",
    "card": r"(?<![\w.\-+])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2,3}(?:[ \-]\d{1,3})?)(?![\w])",
    "name": rf"(?<![\w\p{{L}}])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?(?![\w\p{{L}}])",
}
PATTERN = "|".join(PATTERNS.values())
#: What a text with an entity surely holds.
_MAYBE = rf"[@\d]|(?:{_TITLE})\.? "


def kind_of(m: Column) -> Column:
    """The kind of a match, from its own form."""
    bare = F.regexp_replace(m, r"[^0-9]", "")
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), "ip")
        .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^\p{L}"), "name")
        .when((m.startswith("+") & (F.length(bare) >= _PHONE_DIGITS)) | m.startswith("(") | m.rlike(r"^\d{3}[.\-]\d{3}[.\-]\d{4}$"), "phone")
        .when(~m.startswith("+") & (_check_digit(F.substring(bare, F.lit(1), F.length(bare) - 1)) == F.substring(bare, F.length(bare), F.lit(1))), "card")
    )


def _characters(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))).otherwise(F.array().cast("array<string>"))


def _check_digit(s: Column) -> Column:
    """The digit that makes s and it pass the card check (every second digit from the right doubled, the sum a multiple of ten)."""
    digits = F.transform(F.reverse(_characters(s)), lambda c, i: F.when(i % 2 == 0, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.pmod(-F.aggregate(digits, F.lit(0), lambda a, d: a + d), F.lit(10)).cast("string")


_ALL = "".join(ALPHABETS)


def _shifted(s: Column, stream: Column) -> Column:
    """Each character moved within its alphabet by the stream's bytes; other characters stay."""
    ends = [sum(map(len, ALPHABETS[: i + 1])) for i in range(len(ALPHABETS))]

    def move(c: Column, i: Column) -> Column:
        def there(at: Column) -> Column:
            first, size = F.lit(None), F.lit(None)
            for end, letters in reversed(list(zip(ends, ALPHABETS, strict=True))):
                first = F.when(at <= end, end - len(letters)).otherwise(first)
                size = F.when(at <= end, len(letters)).otherwise(size)
            by = F.conv(F.substring(stream, (i % 31) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            return F.when(at > 0, F.substring(F.lit(_ALL), first + F.pmod(at - 1 - first + by, size) + 1, F.lit(1))).otherwise(c)

        return _let(F.instr(F.lit(_ALL), c), there)

    return F.array_join(F.transform(_characters(s), move), "")


def encipher(s: Column, key: Column) -> Column:
    """A keyed bijection on strings of one format (length, and each place's alphabet)."""

    def round_(state: Column, r: Column) -> Column:
        """The halves change places after each round, so four rounds bring each back to its own."""
        stream = F.sha2(F.concat_ws("|", key, r.cast("string"), state["b"]), 256)
        return F.struct(state["b"].alias("a"), _shifted(state["a"], stream).alias("b"))

    half = F.floor(F.length(s) / 2).cast("int")
    halves = F.struct(F.substring(s, F.lit(1), half).alias("a"), F.substring(s, half + 1, F.length(s)).alias("b"))
    return _let(F.aggregate(F.array(*map(F.lit, range(4))), halves, round_), lambda x: F.concat(x["a"], x["b"]))


def canonical(m: Column, kind: Column) -> Column:
    """What makes two matches one entity: case and separators do not matter."""
    return F.when(kind == "email", F.lower(m)).when(kind.isin("phone", "card", "ssn", "iban"), F.regexp_replace(m, r"[^A-Z0-9]", "")).otherwise(m)


def _as_before(m: Column, compact: Column) -> Column:
    """The characters of compact at the places of m's letters and digits."""
    step = lambda acc, c: F.when(c.rlike("[A-Z0-9]"), F.struct(F.concat(acc["out"], F.substring(compact, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at")))
    return F.aggregate(_characters(m), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step)["out"]


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _address(m: Column, key: Column) -> Column:
    """An IPv4 address as two 16-bit halves through four Feistel rounds."""
    part = lambda s, i: F.split_part(s, F.lit("."), F.lit(i)).cast("long")
    mix = lambda k, r, x: F.conv(F.substring(F.sha2(F.concat_ws("|", k, r.cast("string"), x.cast("string")), 256), F.lit(1), F.lit(4)), 16, 10).cast("long")
    halves = F.struct((part(m, 1) * 256 + part(m, 2)).alias("a"), (part(m, 3) * 256 + part(m, 4)).alias("b"))
    round_ = lambda x, r: F.struct(x["b"].alias("a"), F.pmod(x["a"] + mix(key, r, x["b"]), F.lit(65536)).alias("b"))
    state = F.aggregate(F.array(*map(F.lit, range(4))), halves, round_)
    return _let(state, lambda x: F.concat_ws(".", F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256))


def _by_script(name: Column, of) -> Column:
    """of(script) for the script of a name."""
    out = of("latin")
    for script, letters in _SCRIPTS.items():
        out = F.when(name.rlike(letters), of(script)).otherwise(out)
    return out


def _at(h: Column, i, size: int) -> Column:
    """A number below size from the i-th six digits of a hash."""
    return F.pmod(F.conv(F.substring(h, 1 + 6 * (i % 10 if isinstance(i, Column) else F.lit(i)), F.lit(6)), 16, 10).cast("int"), F.lit(size))


def _attempt(key: str | Column, number: Column) -> Column:
    """The key of an attempt."""
    return F.concat(F.lit(key), F.when(number > 0, F.concat(F.lit("#"), number.cast("string"))).otherwise(""))


def made_surname(base: Column, key: str | Column, number: Column) -> Column:
    """A made-up surname, in lower case, for one in lower case: five syllables of its script (later attempts: nine)."""

    def made(h: Column) -> Column:
        def of(script: str) -> Column:
            known = _SYLLABLES_OF.get(script, _SYLLABLES)
            all_ = F.lit("".join(known))
            some = [F.substring(all_, 2 * _at(h, i, len(known)) + 1, F.lit(2)) for i in range(9)]
            return F.concat(*some[:5], F.when(number >= _ATTEMPTS, F.concat(*some[5:])).otherwise(""))

        return _by_script(base, of)

    return _let(F.sha2(F.concat_ws("|", _attempt(key, number), F.lit("name"), base), 256), made)


def made_given(base: Column, key: str | Column, number: Column) -> Column:
    """A given name for a base gender|given name|surname; every second attempt draws from names with one more part."""

    def made(h: Column) -> Column:
        def of(script: str) -> Column:
            def one(i: Column) -> Column:
                out = F.lit(None)
                for gender, names in GIVEN[script].items():
                    names = names.split()
                    out = F.when(F.substring(base, 1, 1) == gender, F.split_part(F.lit(" ".join(names)), F.lit(" "), _at(F.sha2(F.concat_ws("|", h, i.cast("string")), 256), 0, len(names)) + 1)).otherwise(out)
                return out

            return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(number / 2).cast("int")), one), "-")

        return _by_script(F.split_part(base, F.lit("|"), F.lit(2)), of)

    return _let(F.sha2(F.concat_ws("|", _attempt(key, number), F.lit("given"), base), 256), made)


def _named(m: Column) -> Column:
    """A name's title, given name (null without one), surname, and the base of the given name: gender, given name and surname."""
    rest = F.split(F.regexp_replace(m, rf"^(?:{_TITLE})\.? ", ""), " ")

    def told(x: Column) -> Column:
        bare = F.regexp_replace(x["title"], r"\.", "")
        gender = F.when(F.lower(x["given"]).rlike("[aáàâäаяαάηή]$"), "f").otherwise("m")
        for g, titles in TITLES.items():
            if g != "u":
                gender = F.when(bare.isin(*titles.split()), g).otherwise(gender)
        return F.struct(x["title"].alias("title"), x["given"].alias("given"), x["surname"].alias("surname"), F.when(x["given"].isNotNull(), F.concat_ws("|", gender, F.lower(x["given"]), F.lower(x["surname"]))).alias("base"))

    return _let(_let(rest, lambda w: F.struct(F.regexp_extract(m, rf"^((?:{_TITLE})\.?) ", 1).alias("title"), F.when(F.size(w) > 1, w[0]).alias("given"), F.element_at(w, -1).alias("surname"))), told)


def _cased(made: Column, like: Column) -> Column:
    """A made-up name in capitals where the name it stands for is."""
    return F.when((like == F.upper(like)) & (F.length(like) > 1), F.upper(made)).otherwise(F.initcap(made))


def _name(m: Column, key: str | Column, tries) -> Column:
    """Title kept, a given name where there was one, and a surname; tries(kind, base) tells their attempts."""

    def made(x: Column) -> Column:
        surname = F.lower(x["surname"])
        given = F.when(x["given"].isNotNull(), _let(made_given(x["base"], key, tries("given", x["base"])), lambda g: F.when(x["given"] == F.upper(x["given"]), F.upper(g)).otherwise(g)))
        return F.concat_ws(" ", x["title"], given, _let(made_surname(surname, key, tries("name", surname)), lambda s: _cased(s, x["surname"])))

    return _let(_named(m), made)


def _known(kind: Column, base: Column) -> Column:
    """An entity's key in a map of attempts."""
    return F.concat_ws("/", kind, base)


def surrogate(m: Column, key: str, attempts: dict[str, int] | Column | None = None, number: Column | None = None) -> Column:
    """The surrogate of a match; null where the match is no entity.

    attempts: the number of entities (kind/canonical form) that need another attempt, as a dict or a map column; number: this entity's.
    """
    if isinstance(attempts, dict):
        attempts = F.create_map(*[v for a, n in sorted(attempts.items()) for v in (F.lit(a), F.lit(n))]) if attempts else None

    def made(x: Column) -> Column:
        kind, base, tries = x["kind"], x["base"], x["tries"]
        k, later = _attempt(key, tries), tries >= _ATTEMPTS
        n = F.length(base)
        head = F.when(kind == "iban", 2).when((kind == "card") | ((kind == "phone") & m.startswith("+")), 1).otherwise(0)
        tail = F.when(kind == "email", F.length(F.regexp_extract(base, r"(\.[^.]+)$", 1))).when(kind == "card", 1).otherwise(0)
        plain = F.substring(base, head + 1, n - head - tail)
        inner = encipher(plain, F.concat_ws("/", k, kind))
        if number is not None or attempts is not None:
            inner = F.when((kind == "email") & later, F.concat(_letters(F.concat_ws("/", k, kind, base)), F.lit("@"), F.substring_index(inner, "@", -1))).otherwise(inner)

        def put(x: Column) -> Column:
            whole = F.concat(F.substring(base, F.lit(1), head), x)
            off = F.substring(base, n, F.lit(1)).cast("int") - _check_digit(F.substring(base, F.lit(1), n - 1)).cast("int")
            card = _let(whole, lambda h: F.concat(h, F.pmod(_check_digit(h).cast("int") + off, F.lit(10)).cast("string")))
            mail = F.concat(whole, F.substring(base, n - tail + 1, tail))
            mail = F.when((m == F.upper(m)) & (m != base), F.upper(mail)).otherwise(mail)
            return F.when(kind == "email", mail).otherwise(_as_before(m, F.when(kind == "card", card).otherwise(whole)))

        return F.when(kind == "ip", _address(m, F.concat_ws("/", k, kind))).when(kind == "name", _name(m, key, tries_of)).when(kind.isNotNull(), _let(inner, put))

    def tries_of(kind, base: Column) -> Column:
        if number is not None:
            return number
        return F.lit(0) if attempts is None else F.coalesce(F.try_element_at(attempts, _known(F.lit(kind), base)), F.lit(0))

    def counted(x: Column) -> Column:
        return _let(F.struct(x["kind"].alias("kind"), x["base"].alias("base"), tries_of(x["kind"], x["base"]).alias("tries")), made)

    return _let(F.struct(kind_of(m).alias("kind")), lambda x: _let(F.struct(x["kind"].alias("kind"), canonical(m, x["kind"]).alias("base")), counted))


def _letters(s: Column) -> Column:
    """Sixteen letters that s determines."""
    return F.translate(F.substring(F.sha2(s, 256), F.lit(1), F.lit(16)), "0123456789abcdef", "abcdefghijklmnop")


def _pieces(text: Column) -> Column:
    """The text cut at its matches: what stands between them at even places, the matches at odd ones."""
    found = F.struct(F.split(text, PATTERN, -1).alias("between"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)).alias("found"))
    twice = _let(found, lambda x: F.filter(F.flatten(F.transform(x["between"], lambda p, i: F.array(p, F.get(x["found"], i)))), lambda p: p.isNotNull()))
    once = F.split(F.regexp_replace(text, PATTERN, f"{_MARK}$0{_MARK}"), _MARK, -1)
    return F.when(text.isNull(), None).when(~text.rlike(_MAYBE), F.array(text)).when(text.contains(_MARK), twice).otherwise(once)


def spot(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, pieces): the one pass of the pattern over the texts; the pieces in a row are the text."""
    return docs.select(F.col(doc_id).alias("doc_id"), _pieces(F.col(text)).alias("pieces"))


def _entities_of(m: Column) -> Column:
    """(kind, base, match) of the entities in a match: one, but for names, whose surname and given name are two."""
    whole = lambda kind, base: F.struct(kind.alias("kind"), base.alias("base"), m.alias("match"))
    names = _let(_named(m), lambda x: F.filter(F.array(whole(F.lit("name"), F.lower(x["surname"])), F.when(x["given"].isNotNull(), whole(F.lit("given"), x["base"]))), lambda e: e.isNotNull()))
    return _let(kind_of(m), lambda k: F.when(k == "name", names).otherwise(F.array(whole(k, canonical(m, k)))))


def _spotted_entities(spotted: DataFrame) -> DataFrame:
    """The distinct (kind, base, match, n) of all pieces; one row of each match form, whatever its frequency."""
    rows = spotted.select(F.explode(F.filter("pieces", lambda p, i: i % 2 == 1)).alias("match")).groupBy("match").agg(F.count("*").alias("n"))
    rows = rows.select(F.explode(_entities_of(F.col("match"))).alias("e"), "n").where("e.kind is not null")
    return rows.select("e.kind", "e.base", "e.match", "n")


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct (kind, base, match, n) of all texts."""
    return _spotted_entities(spot(docs.withColumn("_none", F.lit(None)), "_none", text))


def _saturated(found: DataFrame) -> DataFrame:
    """(kind, format) of formats of which the entities fill more than a quarter; found has kind, format and strings (the logarithm of a format's size)."""
    return found.groupBy("kind", "format").agg(F.count("*").alias("n"), F.first("strings").alias("strings")).where(F.log(4 * F.col("n")) > F.col("strings") + 1e-9).select("kind", "format")


def _formatted(found: DataFrame) -> DataFrame:
    """found with each entity's format, and the logarithm of the number of strings that have it."""
    kind, base, n = F.col("kind"), F.col("base"), F.length("base")
    plus = (kind == "phone") & F.col("match").startswith("+")
    head = F.when(kind == "iban", 2).when((kind == "card") | plus, 1).otherwise(0)
    tail = F.when(kind == "email", F.length(F.regexp_extract(base, r"(\.[^.]+)$", 1))).when(kind == "card", 1).otherwise(0)
    inner = F.substring(base, head + 1, n - head - tail)
    shape = F.translate(inner, _ALL, "".join(letters[0] * len(letters) for letters in ALPHABETS))
    size = sum(((F.length(shape) - F.length(F.replace(shape, F.lit(letters[0])))) * math.log(len(letters)) for letters in ALPHABETS), F.lit(0.0))
    # Addresses are one format of 2^32; names come from sets that grow.
    fixed = kind.isin("ip", "name", "given")
    form = F.when(fixed, "").otherwise(F.concat_ws("|", plus.cast("string"), F.substring(base, F.lit(1), head), shape, F.substring(base, n - tail + 1, tail)))
    return found.withColumns({"format": form, "strings": F.when(kind == "ip", 32 * math.log(2)).when(kind.isin("name", "given"), 1e9).otherwise(size)})


def exceptions(spark: SparkSession, docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The collision check: (kind, base, number) of the entities that need another attempt, however many, with the attempt that ends it.

    Each round makes surrogates only of the entities that still meet, so that rounds get smaller until none is left.
    """
    return _exceptions(spark, spot(docs.withColumn("_none", F.lit(None)), "_none", text), key)


def _form(key: str) -> Column:
    """What an entity's surrogate is to the collision check; given names meet only with those of one surname and gender."""
    kind, base, number = F.col("kind"), F.col("base"), F.col("number")
    part = lambda i: F.split_part(base, F.lit("|"), F.lit(i))
    given = F.concat_ws("|", F.lit("made"), part(1), made_given(base, key, number), part(3))
    other = canonical(surrogate(F.col("match"), key, number=number), kind)
    return F.when(kind == "name", made_surname(base, key, number)).when(kind == "given", given).otherwise(other)


def _exceptions(spark: SparkSession, spotted: DataFrame, key: str) -> DataFrame:
    """exceptions() of the rows of spot()."""
    found = stored(spark, _formatted(_spotted_entities(spotted).groupBy("kind", "base").agg(F.min("match").alias("match"))), "entities")
    forms = found.select("kind", F.col("base").alias("form"))
    full = stored(spark, _saturated(found), "saturated")
    state = found.select("kind", "base", "match", "format")
    if full.isEmpty():
        state = state.withColumn("full", F.lit(False))
    else:
        state = state.join(full.withColumn("full", F.lit(True)), ["kind", "format"], "left").withColumn("full", F.coalesce("full", F.lit(False)))
    # No key helps an e-mail address of a format with few strings: it takes one of the larger set.
    state = state.select("kind", "base", "match", (F.col("full") & (F.col("kind") != "email")).alias("fixed"), F.when(F.col("full") & (F.col("kind") == "email"), _ATTEMPTS).otherwise(0).alias("number"))
    settled, out = None, None
    while True:
        made = state.withColumn("form", _form(key))
        made = stored(spark, made, "made")
        # Of equal ones the first stays, and what may have no other attempt comes first.
        first = F.min(F.struct(~F.col("fixed"), F.col("base")))["base"]
        twice = made.groupBy("kind", "form").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1").select("kind", "form", "first")
        clash = made.join(twice, ["kind", "form"]).where("base <> first").select("kind", "base")
        meet = clash.unionAll(made.join(forms, ["kind", "form"], "left_semi").select("kind", "base"))
        if settled is not None:
            meet = meet.unionAll(made.join(settled, ["kind", "form"], "left_semi").select("kind", "base"))
        meet = stored(spark, meet.join(made.where("fixed").select("kind", "base"), ["kind", "base"], "left_anti").distinct(), "meet")
        over = meet.isEmpty()
        good = made if over else made.join(meet, ["kind", "base"], "left_anti")
        moved = good.where("number > 0").select("kind", "base", "number")
        out = moved if out is None else out.unionAll(moved)
        if over:
            return stored(spark, out, "exceptions")
        good = good.select("kind", "form")
        settled = stored(spark, good if settled is None else settled.unionAll(good), "settled")
        state = made.join(meet, ["kind", "base"], "left_semi").select("kind", "base", "match", "fixed", (F.col("number") + 1).alias("number"))


def _literal(found: DataFrame) -> dict[str, int] | None:
    """Exceptions as a dict by kind/canonical form; None if they are too many for it."""
    rows = found.limit(MOST_EXCEPTIONS + 1).collect()
    return {f"{r.kind}/{r.base}": r.number for r in rows} if len(rows) <= MOST_EXCEPTIONS else None


def attempts(spark: SparkSession, docs: DataFrame, key: str, text: str = "text") -> dict[str, int]:
    """The exceptions as a dict; fails beyond MOST_EXCEPTIONS of them, for which replace takes the table of exceptions()."""
    if (out := _literal(exceptions(spark, docs, key, text))) is None:
        raise ValueError("too many surrogates meet for a dict; use exceptions()")
    return out


def _with_tries(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows of spot() with tries: a map of the exceptions among the text's entities. Equal texts share one map."""
    here = F.xxhash64("pieces")
    each = rows.select(here.alias("_at"), F.explode(F.filter("pieces", lambda p, i: i % 2 == 1)).alias("match")).distinct()
    each = each.select("_at", F.explode(_entities_of(F.col("match"))).alias("e")).where("e.kind is not null")
    each = each.select("_at", "e.kind", "e.base").distinct().join(found, ["kind", "base"])
    maps = each.groupBy("_at").agg(F.map_from_entries(F.collect_set(F.struct(_known(F.col("kind"), F.col("base")), "number"))).alias("tries"))
    return rows.withColumn("_at", here).join(maps, "_at", "left").drop("_at")


def replace(docs: DataFrame, key: str, tries: dict[str, int] | DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_entities, kinds): each row's text with its entities replaced, their number, and the kinds met; tries: from attempts() or exceptions()."""
    return _replaced(spot(docs, doc_id, text), key, tries)


def _replaced(rows: DataFrame, key: str, tries: dict[str, int] | DataFrame | None) -> DataFrame:
    """replace() of the rows of spot()."""
    if isinstance(tries, DataFrame) and (few := _literal(tries)) is not None:
        tries = few
    if isinstance(tries, DataFrame):
        rows, tries = _with_tries(rows, tries), F.col("tries")
    none = F.lit(None).cast("string")

    def piece(p: Column, i: Column) -> Column:
        new = _let(surrogate(p, key, tries), lambda made: F.struct(F.coalesce(made, p).alias("text"), F.when(made.isNotNull(), kind_of(p)).alias("kind")))
        return F.when(i % 2 == 1, new).otherwise(F.struct(p.alias("text"), none.alias("kind")))

    rows = rows.withColumn("made", F.transform("pieces", piece))
    kinds = F.filter("made.kind", lambda k: k.isNotNull())
    return rows.select(
        "doc_id",
        F.array_join("made.text", "").alias("text"),
        F.coalesce(F.size(kinds), F.lit(0)).cast("long").alias("n_entities"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit("")).alias("kinds"),
    )


def surrogates(spark: SparkSession, docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """replace() with the collision check; the texts are searched once, and their pieces stored for both."""
    rows = stored(spark, spot(docs, doc_id, text), "pieces")
    return _replaced(rows, key, _exceptions(spark, rows, key))
