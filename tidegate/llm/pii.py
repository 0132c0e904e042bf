"""Personal data replaced by surrogates.

What a text holds of personal data is found by patterns that take linear time
and constant stack. Each mention is brought to an identity: mail in lower case,
the digits of phones, cards and social security numbers, the words of names
without their titles. An identity has one keyed surrogate of its own type
everywhere, so who is who survives, but nothing can be turned back without the
key. Mentions keep their format (letter case, digits, punctuation, length),
names their script and gender, cards and IBANs their checksum.

A name is found by its title. From then on each of its words counts as a name
in that document, wherever it stands: ``Mr. John Smith met Dr John Smith;
Smith paid`` speaks of one person before and after. Given and family names have
identities of their own, so that people who share one share it still. A given
name's gender is its title's, else that of the document's other titles of the
name, else that of all titles of the same person in the corpus; else neutral.

A surrogate is a function of key, kind, identity and attempt. The first attempt
serves nearly all. A distributed check over all identities finds those whose
surrogate another has, or is itself someone's real data; they try again until
all are distinct. Only those few are joined back.

All of it is DataFrame functions. Patterns are tried in the order of KINDS.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import Scratch, packed, spread, table

# Java's matcher recurses for a repeated group that may give back, and starts
# anew at each letter of a run unless a look-behind forbids it. So repeats
# without a bound are of single classes or possessive (``++``), and anchored.
_LABEL = r"[\p{L}0-9]++(?:-++[\p{L}0-9]++)*+"
_EMAIL = rf"(?<![\p{{L}}0-9._%+\-])[\p{{L}}0-9][\p{{L}}0-9._%+\-]*+@(?=[\p{{L}}0-9.\-]*\.\p{{L}}{{2}}){_LABEL}(?:\.{_LABEL})++"
_URLUSER = r"(?<=://)[^\s/:@]++:[^\s/@]++(?=@)"
_CLOUD = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z2-7]{16}(?![A-Za-z0-9])"
#: What a secret is given to, in any case: `password=x`, `TOKEN = "x"`, `"api_key": 'x'`, `secret: x`.
_KEYS = r"(?i:passw(?:or)?d|pwd|passphrase|token|(?:api|secret|access|private)[_\-]?(?:access[_\-]?)?key|secret)"
_KEYED = rf"{_KEYS}\\?[\"']?[ \t]{{0,8}}(?::=|=>|[=:])[ \t]{{0,8}}\\?"
_BEARER = r"(?<!\p{L})(?i:bearer)[ \t]"
_SECRET = (
    rf"{_KEYED}(?:\"[^\"\r\n]{{4}}[^\"\r\n]*+(?=\")|'[^'\r\n]{{4}}[^'\r\n]*+(?=')|[\"']?[^\s\"'&;,]{{4}}[^\s\"'&;,]*+)"
    rf"|{_BEARER}(?=[\w.~+/\-]*[0-9]|[\w.~+/\-]{{20}})[\w.~+/\-]{{4}}[\w.~+/\-]*+=*+"
)
_IP = r"(?<![\d.vV])(?<!(?i:version|release|build)[ :]{0,2})(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
_CARD = r"(?<![\d\-])(?:\d{4}[ \-]?){3}\d{4}(?![\d\-])|(?<![\d\-])3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5}(?![\d\-])"
_SSN = r"(?<![\d\-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d\-])"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Titles, by gender.
FEMALE = "Mrs|Ms|Miss|Madame|Mme|Frau|Señora|Sra|Signora|Lady|г-жа|госпожа|κυρία"
MALE = "Mr|Mister|Sir|Monsieur|Herr|Señor|Sr|Signor|Lord|г-н|господин|κύριος"
NEUTRAL = "Dr|Prof|Mx"
#: What follows a title and is no name, and words within names that aren't replaced.
_NO_NAME = "Of|The|And|In|On|At|For|To|World|Universe|America|Developer|Engineer|Manager|Director|Analyst|Consultant|Architect|Vice|President"
_PARTICLES = "van|von|der|den|de|del|della|di|da|dos|la|le|bin|al|el"
_WORD = r"\p{Lu}(?:['’]\p{Lu})?[\p{Ll}\p{M}]++(?:\p{Lu}[\p{Ll}\p{M}]++)*+"
_INITIALS = r"(?:\p{Lu}\. ?){0,3}"
_TITLE = rf"(?<!\p{{L}})(?:{FEMALE}|{MALE}|{NEUTRAL})\.? "
_TITLED = rf"{_TITLE}(?!(?:{_NO_NAME})(?!\p{{L}})){_INITIALS}(?:(?:{_PARTICLES}) ){{0,2}}{_WORD}(?:[ \-](?:(?:{_PARTICLES}) ){{0,2}}{_WORD}){{0,3}}"
_BARE = rf"(?<!\p{{L}}){_WORD}(?:[ \-]{_WORD}){{0,3}}"

KINDS = (("email", _EMAIL), ("login", _URLUSER), ("cloud", _CLOUD), ("secret", _SECRET), ("ip", _IP), ("card", _CARD), ("ssn", _SSN), ("phone", _PHONE), ("iban", _IBAN), ("name", _TITLED))
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
#: For documents with a titled name: all else that may be a name, too.
WIDE = f"{PATTERN}|(?:{_BARE})"
#: What every entity has somewhere: found fast, it spares most texts the pattern.
_NUMBERS = r"[0-9]{3}|[0-9]\.[0-9]|[A-Z]{2}[0-9]{2}|(?i:bearer)[ \t]"
HINTS = ("@", "=", ":", "AKIA", "ASIA", *(f"{t}{end}" for t in f"{FEMALE}|{MALE}|{NEUTRAL}".split("|") for end in (" ", ". ")))

#: Names by script and gender, for the first attempt; later ones are made of syllables and an ending.
GIVEN = {
    ("latin", "f"): "Alma Berta Clara Dora Edith Frida Greta Hilda Irma Jana Klara Lena Mona Nora Olga Petra".split(),
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marco Niko Oscar Paul".split(),
    ("latin", "n"): "Alex Blair Chris Dana Eden Finn Gray Harper Indy Jules Kim Lou Morgan Noel Quinn Robin".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Игорь Кирилл".split(),
    ("cyrillic", "n"): "Саша Женя Валя Слава".split(),
    ("greek", "f"): "Άννα Βασιλική Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Στέλιος Χρήστος".split(),
    ("greek", "n"): "Αναστάση Κυριακή".split(),
}
ENDINGS = {
    "latin": {"f": "na", "m": "nus", "n": "ny"},
    "cyrillic": {"f": "на", "m": "слав", "n": "ня"},
    "greek": {"f": "να", "m": "νος", "n": "νω"},
}
#: Syllables of names by script.
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi fo ga ge gi go ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе би бо ва ве ви во да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро".split(),
    "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο".split(),
}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value worked out once, however often then uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits."""
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, x: a + x)


def _mod97(iban: Column) -> Column:
    """The remainder that makes an IBAN valid if it is 1; no spaces, upper case."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(c <= "9", (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(_chars(turned), F.lit(0), step)


def kind_of(e: Column) -> Column:
    """The kind of a mention, null for one whose checksum fails; what no pattern fits whole is a login, known by its context."""
    whole = lambda p: F.regexp_like(e, F.lit(rf"\A(?:{p})\z"))
    c = F.when(F.regexp_like(e, F.lit(rf"\A(?:{_KEYED}|{_BEARER})")), "secret").when(whole(_TITLED), "name").when(whole(_EMAIL), "email")
    c = c.when(whole(_CARD), F.when(_luhn(_digits(e)) % 10 == 0, "card")).when(whole(_IBAN), F.when(_mod97(F.replace(e, F.lit(" "), F.lit(""))) == 1, "iban"))
    for name, p in KINDS:
        if name in ("cloud", "ip", "ssn", "phone"):
            c = c.when(whole(p), name)
    return c.when(F.contains(e, F.lit(":")), "login")


def identity(kind: Column, e: Column) -> Column:
    """What all spellings of an entity share; a secret's value without its key. Names have identities by word."""
    digits = _digits(e)
    return (
        F.when(kind == "email", F.lower(e))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.when(F.startswith(e, F.lit("+")), F.concat(F.lit("+"), digits)).when(F.length(digits) == 10, F.concat(F.lit("+1"), digits)).otherwise(digits))
        .when(kind == "iban", F.replace(e, F.lit(" "), F.lit("")))
        .when(kind == "secret", F.regexp_replace(e, rf"\A(?:{_KEYED}[\"']?|{_BEARER})", ""))
        .otherwise(e)
    )


def script_of(word: Column) -> Column:
    return F.when(F.regexp_like(word, F.lit(r"\p{IsCyrillic}")), "cyrillic").when(F.regexp_like(word, F.lit(r"\p{IsGreek}")), "greek").otherwise("latin")


def _at(hexes: Column, i: Column) -> Column:
    """The i-th number 0 to 65535 of 32 in a SHA-512 in hex, going round."""
    return F.conv(F.substr(hexes, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _reshaped(e: Column, hexes: Column) -> Column:
    """Each letter and digit by a keyed one of its class; other characters stay.

    Digits stay digits; letters keep case and script (Latin, Cyrillic, Greek;
    other letters become Latin). Hexadecimal strings stay hexadecimal.
    """
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    cyr, greek = "абвгдежзиклмнопрстуфхцчшщыэюя", "αβγδεζηθικλμνξοπρστυφχψω"

    def one(c: Column, i: Column) -> Column:
        # past the hash's 32 numbers a long string's position is mixed in
        v = _at(hexes, i) + (F.floor(i / 32) * 7919).cast("int")
        pick = lambda s: F.substr(F.lit(s), v % len(s) + 1, F.lit(1))
        cased = lambda s: F.when(F.lower(c) != c, F.upper(pick(s))).otherwise(pick(s))
        return (
            F.when(c.between("0", "9"), pick(digits))
            .when(c.between("a", "z"), pick(lower))
            .when(c.between("A", "Z"), pick(upper))
            .when(c <= "\x7f", c)
            .when(F.regexp_like(c, F.lit(r"\p{IsCyrillic}")), cased(cyr))
            .when(F.regexp_like(c, F.lit(r"\p{IsGreek}")), cased(greek))
            .when(F.regexp_like(c, F.lit(r"\p{L}")), F.when(F.lower(c) != c, pick(upper)).otherwise(pick(lower)))
            .otherwise(c)
        )

    def hexadecimal(alphabet: str) -> Column:
        pick = lambda c, i: F.substr(F.lit(alphabet), (_at(hexes, i) + (F.floor(i / 32) * 7919).cast("int")) % 16 + 1, F.lit(1))
        return F.array_join(F.transform(_chars(e), pick), "")

    is_hex = lambda letters: F.regexp_like(e, F.lit(rf"\A[0-9{letters}]*\z")) & F.regexp_like(e, F.lit("[0-9]")) & F.regexp_like(e, F.lit(f"[{letters}]"))
    return F.when(is_hex("a-f"), hexadecimal("0123456789abcdef")).when(is_hex("A-F"), hexadecimal("0123456789ABCDEF")).otherwise(F.array_join(F.transform(_chars(e), one), ""))


def _card(e: Column, new: Column) -> Column:
    """The first digit stays; the last makes the checksum hold."""
    body = F.concat(F.substr(e, F.lit(1), F.lit(1)), F.substr(new, F.lit(2), F.length(e) - 2))
    return _let(body, lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))


def _iban(e: Column, new: Column) -> Column:
    """The country stays; check digits hold."""
    country, rest = F.substr(e, F.lit(1), F.lit(2)), F.upper(F.substr(new, F.lit(5)))
    return F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0"), rest)


def _phone(e: Column, new: Column, attempt: Column) -> Column:
    """The country code stays; a North American exchange is 555, which no one has."""
    code = F.regexp_extract(e, r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})", 0)
    new = F.concat(code, F.substr(new, F.length(code) + 1))
    american = F.regexp_replace(F.regexp_replace(new, r"^\+1[01]", "+12"), r"\d{3}(\d{4})$", "555$1")
    return F.when((code == "+1") & (F.length(e) == 12) & (attempt < 6), american).otherwise(new)


def _ip(hexes: Column, attempt: Column) -> Column:
    """An address that no one on the net has: of 10.0.0.0/8, or, should that be too narrow, of 240.0.0.0/4."""
    first = F.when(attempt < 3, "10").otherwise((240 + _at(hexes, F.lit(3)) % 16).cast("string"))
    return F.concat_ws(".", first, *[(_at(hexes, F.lit(i)) % 256).cast("string") for i in range(3)])


def _email(new: Column, hexes: Column, attempt: Column) -> Column:
    """The local part keeps its format, and grows if that is too narrow; the domain is one kept for examples."""
    local = F.substring_index(new, "@", 1)
    more = F.when(attempt >= 3, F.substr(hexes, F.lit(100), F.lit(6))).otherwise("")
    host = F.element_at(F.array(*[F.lit(x) for x in ("example.org", "example.net", "example.edu")]), _at(hexes, F.lit(30)) % 3 + 1)
    return F.concat(local, more, F.lit("@"), host)


def _spoken(word: Column, hexes: Column, kind: Column, gender: Column, attempt: Column) -> Column:
    """A given name of a gender, or a family name, in the word's script; longer at later attempts."""
    pools = {f"{script} {g}": names for (script, g), names in GIVEN.items()}
    table_of = lambda t: F.create_map(*[x for k, v in t.items() for x in (F.lit(k), F.lit(v))])
    family = kind == "family"

    def in_script(script: Column) -> Column:
        syllables = F.element_at(table_of(SYLLABLES), script)
        many = F.when(family, F.least(4 + F.floor(attempt / 2), F.lit(8))).otherwise(F.least(2 + F.floor(attempt / 2), F.lit(6))).cast("int")
        stem = F.array_join(F.transform(F.sequence(F.lit(1), many), lambda i: F.element_at(syllables, _at(hexes, i) % F.size(syllables) + 1)), "")
        known = F.element_at(table_of(pools), F.concat_ws(" ", script, gender))
        ending = F.element_at(table_of({f"{s} {g}": e for s, by in ENDINGS.items() for g, e in by.items()}), F.concat_ws(" ", script, gender))
        return F.when(~family & (attempt == 0), F.element_at(known, _at(hexes, F.lit(0)) % F.size(known) + 1)).otherwise(F.initcap(F.concat(stem, F.when(family, "").otherwise(ending))))

    return _let(script_of(word), in_script)


def surrogate(kind: Column, ident: Column, gender: Column, key: str, attempt: Column) -> Column:
    """The keyed surrogate of an identity at an attempt; gender: f, m or n of given names, else anything."""
    hexes = F.sha2(F.concat_ws("\x1f", F.lit(_marked(key)), kind, gender, ident, attempt.cast("string")), 512)
    # a second round of hashing with the key in front: lengths of the first can't be extended
    hexes = F.sha2(F.concat(F.lit(_marked(key)), hexes), 512)

    def other(h: Column, new: Column) -> Column:
        """new: the identity with each letter and digit by another."""
        return (
            F.when(kind == "email", _email(new, h, attempt))
            .when(kind == "card", _card(ident, new))
            .when(kind == "iban", _iban(ident, new))
            .when(kind == "phone", _phone(ident, new, attempt))
            # areas from 900 are nobody's
            .when(kind == "ssn", F.concat(F.lit("9"), F.substr(new, F.lit(2))))
            .when(kind == "cloud", F.concat(F.substr(ident, F.lit(1), F.lit(4)), F.translate(F.upper(F.substr(new, F.lit(5))), "0189", "2345")))
            # a secret of few letters and digits grows if that is too narrow
            .otherwise(F.concat(new, F.when(attempt >= 3, F.substr(h, F.lit(100), F.lit(6))).otherwise("")))
        )

    def of(h: Column) -> Column:
        c = F.when(kind == "ip", _ip(h, attempt)).when(kind.isin("given", "family"), _spoken(ident, h, kind, gender, attempt))
        return c.otherwise(_let(_reshaped(ident, h), lambda new: other(h, new)))

    return _let(hexes, of)


def _written(kind: Column, raw: Column, surrogate_of: Column) -> Column:
    """A surrogate in its mention's format: digits laid into its punctuation, letters in its case."""

    def laid(digits: Column, is_slot: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit("").alias("s"), F.lit(0).alias("n"))
        step = lambda a, c: F.struct(F.concat(a["s"], F.when(is_slot(c), F.substr(digits, a["n"] + 1, F.lit(1))).otherwise(c)).alias("s"), (a["n"] + is_slot(c).cast("int")).alias("n"))
        return F.aggregate(_chars(raw), start, step)["s"]

    def of(new: Column) -> Column:
        from_right = F.substr(_digits(new), F.length(_digits(new)) - F.length(_digits(raw)) + 1)
        cased = F.array_join(F.zip_with(_chars(new), _chars(F.substring_index(raw, "@", 1)), lambda n, r: F.when(r.isNotNull() & (F.lower(r) != r), F.upper(n)).otherwise(F.coalesce(n, F.lit("")))), "")
        return (
            F.when(kind.isin("phone", "card", "ssn"), _let(from_right, lambda d: laid(d, lambda c: c.between("0", "9"))))
            .when(kind == "iban", laid(new, lambda c: c != " "))
            .when(kind == "email", cased)
            .when(kind == "secret", F.concat(F.regexp_extract(raw, rf"\A(?:{_KEYED}[\"']?|{_BEARER})", 0), new))
            .otherwise(new)
        )

    return _let(surrogate_of, of)


_KEY_MARK = "pii-key("


def _marked(key: str) -> str:
    return f"{_KEY_MARK}{key})"


def _hide_keys(spark: SparkSession) -> None:
    """Has Spark strike keys out of the plans that it shows and logs."""
    name, mine = "spark.sql.redaction.string.regex", r"pii-key\([^\n]*?\)"
    now = spark.conf.get(name, None)
    if not now or mine not in now:
        spark.conf.set(name, f"{now}|{mine}" if now else mine)


def entities(text: Column) -> Column:
    """(named, e): all that the patterns find in a text, in order; if names are among it, also all that may repeat them."""
    hint = F.regexp_like(text, F.lit(_NUMBERS))
    for h in HINTS:
        hint = hint | F.contains(text, F.lit(h))
    none = F.lit([]).cast("array<string>")
    found = F.when(hint, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(none)
    named = lambda e: F.exists(e, lambda x: F.regexp_like(x, F.lit(rf"\A(?:{_TITLED})\z")))
    return _let(F.coalesce(found, none), lambda e: _let(named(e), lambda n: F.struct(n.alias("named"), F.when(n, F.regexp_extract_all(text, F.lit(WIDE), F.lit(0))).otherwise(e).alias("e"))))


def _one_of(c: str) -> Column:
    """The value that all rows of a group agree on, nulls aside; else null."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def _people(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(rid, word, kind, gender): what each word is that a title has made a name, by document."""
    titled = words.where("gender is not null and family is not null")
    who = scratch.keep(titled.select("rid", "pos", "w", "word", "family", F.when(F.col("gender") != "n", F.col("gender")).alias("told"), (F.col("word") == F.col("family")).alias("last")))
    given = who.where("not last")
    doc = given.groupBy("rid", F.col("word").alias("given"), "family").agg(_one_of("told").alias("told"), F.count("told").alias("titles"))
    # a person's gender by other documents, only for those whom their own doesn't tell
    unsure = doc.where("titles = 0")
    corpus = given.groupBy(F.col("word").alias("given"), "family").agg(_one_of("told").alias("elsewhere")).where("elsewhere is not null")
    unsure = unsure.join(corpus, ["given", "family"], "left").select("rid", "given", "elsewhere")
    known = doc.where("titles > 0").select("rid", "given", F.col("told").alias("gender"), F.lit(None).cast("string").alias("elsewhere"), (F.col("told").isNull()).alias("torn"))
    known = known.union(unsure.select("rid", "given", F.lit(None).cast("string"), "elsewhere", F.lit(False)))
    told = known.groupBy("rid", "given").agg(_one_of("gender").alias("g"), _one_of("elsewhere").alias("e"), F.max("torn").alias("torn"), (F.min("gender") < F.max("gender")).alias("both"))
    gender = F.when(F.col("torn") | F.coalesce("both", F.lit(False)), "n").otherwise(F.coalesce("g", "e", F.lit("n")))
    firsts = told.select("rid", F.col("given").alias("word"), F.lit("given").alias("kind"), gender.alias("gender"))
    lasts = who.where("last").select("rid", "word").distinct().join(firsts, ["rid", "word"], "left_anti").select("rid", "word", F.lit("family").alias("kind"), F.lit("").alias("gender"))
    return scratch.keep(firsts.union(lasts))


def _pieces(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(rid, pos, w, raw, sep, kind, ident, gender): mentions, names by word; kind null is what stays as it is."""
    e = F.posexplode("e").alias("pos", "raw")
    flat = found.where("not named").select("rid", e).withColumn("kind", kind_of(F.col("raw")))
    wide = scratch.keep(found.where("named").select("rid", e).withColumn("kind", kind_of(F.col("raw"))).withColumn("bare", F.col("kind").isNull() & F.regexp_like("raw", F.lit(rf"\A(?:{_BARE})\z"))))
    raw = F.col("raw")
    plain = flat.union(wide.where("not bare and not kind <=> 'name'").drop("bare"))
    plain = plain.select("rid", "pos", F.lit(0).alias("w"), "raw", F.lit("").alias("sep"), "kind", identity(F.col("kind"), raw).alias("ident"), F.lit("").alias("gender"))
    if wide.isEmpty():
        return scratch.keep(plain)

    title = F.when(F.col("kind") == "name", F.regexp_extract(raw, rf"\A{_TITLE}", 0)).otherwise("")
    bare_title = F.regexp_replace(title, r"\.? \z", "")
    gender = F.when(F.col("kind") == "name", F.when(F.regexp_like(bare_title, F.lit(rf"\A(?:{FEMALE})\z")), "f").when(F.regexp_like(bare_title, F.lit(rf"\A(?:{MALE})\z")), "m").otherwise("n"))
    names = wide.where("bare or kind = 'name'").select("rid", "pos", title.alias("title"), gender.alias("gender"), F.when(F.col("kind") == "name", F.substr(raw, F.length(title) + 1)).otherwise(raw).alias("rest"))
    part = F.regexp_extract_all("rest", F.lit(r"[^ \-]+[ \-]?"), F.lit(0))
    stripped = lambda x: F.regexp_replace(x, r"[ \-]\z", "")
    is_word = lambda x: F.regexp_like(x, F.lit(rf"\A(?:{_WORD})\z"))
    names = names.withColumn("parts", part).withColumn("family", F.when(F.col("gender").isNotNull(), F.try_element_at(F.filter(F.transform("parts", stripped), is_word), F.lit(-1))))
    words = names.select("rid", "pos", "title", "gender", "family", F.posexplode("parts").alias("w", "part"))
    words = words.select("rid", "pos", "w", F.when(F.col("w") == 0, F.col("title")).otherwise("").alias("title"), "gender", "family", stripped(F.col("part")).alias("word"), F.regexp_extract("part", r"[ \-]\z", 0).alias("sep"))
    words = scratch.keep(words)
    people = _people(words.where(is_word(F.col("word"))), scratch)
    told = words.join(people.withColumnRenamed("gender", "known"), ["rid", "word"], "left")
    # a title in front tells more than the rest of the document
    own = F.when(F.col("gender").isin("f", "m"), F.col("gender"))
    initials = F.col("gender").isNotNull() & F.regexp_like("word", F.lit(r"\A(?:\p{Lu}\.)+\z"))
    kind = F.when(initials, "initials").otherwise(F.col("kind"))
    told = told.select("rid", "pos", "w", F.concat("title", "word").alias("raw"), "sep", kind.alias("kind"), F.when(kind.isNotNull(), F.col("word")).alias("ident"), F.when(F.col("kind") == "given", F.coalesce(own, F.col("known"))).otherwise("").alias("gender"))
    return scratch.keep(plain.union(told))


_IDENTITY = ["kind", "ident", "gender"]


def _retries(pieces: DataFrame, key: str, scratch: Scratch, most: int = 50) -> DataFrame:
    """(kind, ident, gender, attempt) of the identities whose first surrogate won't do."""
    s = lambda attempt: surrogate(F.col("kind"), F.col("ident"), F.col("gender"), key, F.lit(attempt)).alias("s")
    # one identity of many documents is combined before the shuffle
    all_of = pieces.where("kind is not null and kind <> 'initials'").groupBy(*_IDENTITY).count().drop("count")
    tried = scratch.keep(all_of.select(*_IDENTITY, s(0)))
    real = tried.select("kind", F.col("ident").alias("s")).distinct()

    def clashing(new: DataFrame, taken: DataFrame | None) -> DataFrame:
        """Of new: all but the smallest identity of a surrogate, and those whose surrogate is taken or real."""
        first = new.groupBy("kind", "s").agg(F.min(F.struct("ident", "gender")).alias("first"), F.count(F.lit(1)).alias("c"))
        bad = new.join(first.where("c > 1"), ["kind", "s"]).where(F.struct("ident", "gender") != F.col("first")).select(*_IDENTITY)
        bad = bad.union(new.join(real, ["kind", "s"], "left_semi").select(*_IDENTITY))
        if taken is not None:
            bad = bad.union(new.join(taken, ["kind", "s"], "left_semi").select(*_IDENTITY))
        return bad.distinct()

    bad = scratch.keep(clashing(tried, None))
    taken = tried.join(bad, _IDENTITY, "left_anti").select("kind", "s")
    good = bad.where("1 = 0").withColumn("attempt", F.lit(0))
    for attempt in range(1, most + 1):
        if bad.isEmpty():
            break
        new = scratch.keep(bad.select(*_IDENTITY, s(attempt)))
        bad = scratch.keep(clashing(new, taken))
        ok = new.join(bad, _IDENTITY, "left_anti")
        good = good.union(ok.select(*_IDENTITY, F.lit(attempt)))
        taken = taken.union(ok.select("kind", "s"))
    else:
        raise RuntimeError(f"surrogates still clash after {most} attempts")
    return scratch.keep(good)


def pseudonymise(docs: DataFrame, scratch: Scratch, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text_col``, and n_entities long, the mentions replaced.

    Null texts stay null, empty ones empty; both have no mentions. A text that
    repeats has the same surrogates each time. Texts may be of any length: each
    pattern takes linear time. Ids aren't used, so rows may repeat them. Other
    columns stay as they are, whatever their names; an n_entities that is there
    already is replaced. An empty table gives an empty one.
    """
    _hide_keys(docs.sparkSession)
    text = F.col("text")
    rows = spread(docs).select(packed(docs, text_col).alias("row"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.select("row", "text", entities(text).alias("found")).select("row", "text", "found.named", "found.e", F.monotonically_increasing_id().alias("rid"))
    found = scratch.keep(rows)
    dirty = found.where("size(e) > 0")
    pieces = _pieces(dirty.select("rid", "named", "e"), scratch)
    again = _retries(pieces, key, scratch)
    if again.isEmpty():
        tried = pieces.withColumn("attempt", F.lit(0))
    else:
        tried = pieces.join(again, _IDENTITY, "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    kind, raw = F.col("kind"), F.col("raw")
    new = _written(kind, raw, surrogate(kind, F.col("ident"), F.col("gender"), key, F.col("attempt")))
    # a name's first word has its title with it
    title = F.substr(raw, F.lit(1), F.length(raw) - F.length("ident"))
    new = F.when(kind.isNull(), raw).when(kind.isin("given", "family", "initials"), F.concat(title, new)).otherwise(new)
    piece = tried.select("rid", "pos", "w", F.concat(new, F.col("sep")).alias("new"), kind.isNotNull().alias("hit"))
    sorted_new = lambda by: F.transform(F.array_sort(F.collect_list(F.struct(by, "new"))), lambda x: x["new"])
    token = piece.repartition("rid").groupBy("rid", "pos").agg(F.array_join(sorted_new("w"), "").alias("new"), F.max("hit").alias("hit"))
    by_row = token.groupBy("rid").agg(sorted_new("pos").alias("new"), F.count_if("hit").alias("n"))
    parts = F.when(F.col("named"), F.split("text", WIDE, -1)).otherwise(F.split("text", PATTERN, -1))
    joined = _let(F.col("new"), lambda n: F.array_join(F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.get(n, i), F.lit("")))), ""))
    changed = dirty.join(by_row, "rid").select("row", F.when(F.col("n") > 0, joined).otherwise(text).alias("text"), F.col("n").cast("long").alias("n"))
    out = found.where("size(e) = 0").select("row", "text", F.lit(0).cast("long").alias("n")).union(changed)
    cols = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() != "n_entities"]
    return out.select(*cols, F.col("n").alias("n_entities"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), Scratch(spark, "pii"), key="tidegate-example-key").select("doc_id", "lang", "source", "n_entities", "text")


ORACLE = None
