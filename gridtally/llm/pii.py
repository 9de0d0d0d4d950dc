"""Surrogates for personal data, with DataFrame functions only.

One pattern finds the entities of a text. Every entity of a type gets a keyed surrogate of the same
type and format: digits for digits, letters for letters, names of the same gender and script. Surrogates
are drawn for the distinct entities of all texts at once and checked: no two entities share one, and
none is an entity itself; what collides is drawn again. One entity has one surrogate wherever and
however it is written, so texts still tell who is who. The names that a text holds after a form of
address are found again where they stand without one in that text, but not after an English or German
article ("the White House"), and a month's name not after "in" and the like.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import stored

# Forms of address and the gender they tell; fixed values.
MALE = ("Mr", "MR", "Mister", "Herr", "HERR", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин",
        "Г-н", "Κύριος")
FEMALE = ("Mrs", "MRS", "Ms", "MS", "Miss", "Frau", "FRAU", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora",
          "Señorita", "Sra", "Srta", "Signora", "Госпожа", "Г-жа", "Κυρία")
NEUTRAL = ("Dr", "DR", "Prof", "PROF", "Professor", "Доктор")
#: These stand for other things too and are forms of address only before a full stop.
DOTTED = ("MS", "DR", "PROF")
#: Words that are part of no name, though a sentence in capitals puts them after one; fixed values.
COMMON = ("and", "are", "das", "der", "die", "had", "has", "hat", "is", "ist", "or", "said", "says", "the", "und",
          "war", "was", "were", "who")
#: After these words a word is not the name that it looks like; fixed values.
ARTICLES = ("the", "der", "die", "das", "dem", "den", "des", "ein", "eine", "einem", "einen", "einer")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december")
BEFORE_MONTHS = ("by", "early", "in", "last", "late", "next", "of", "since", "this", "until")

_NAME = rf"(?!(?i:{'|'.join(COMMON)})(?![\p{{L}}'’-]))\p{{Lu}}[\p{{L}}'’-]*+"
_EDGE = r"(?<![\p{L}\p{N}])"
_END = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = "|".join(t + r"(?=\.)" if t in DOTTED else t for t in MALE + FEMALE + NEUTRAL)
#: Networks whose addresses are nobody's own; fixed values.
PRIVATE = r"^(?:10|127|192\.168|169\.254|172\.(?:1[6-9]|2\d|3[01]))\."
_KEY = r"(?:sk|pk|rk)_(?:live|test)_"
_VALUE = r"[^\s\"'&;,<>]"
# Nothing begins right after a letter or a digit, which one look back tells at most places.
PATTERN = _EDGE + "(?:" + "|".join((
    # e-mail addresses
    r"(?<![\p{L}\p{N}._+-])[\p{L}\p{N}._+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    # network addresses
    rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[\p{{L}}\p{{N}}])",
    rf"(?<![\p{{L}}\p{{N}}:])(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}{_END}",
    # compressed, from a whole first group on, so that a slice like [1::2] is none
    r"(?<![\p{L}\p{N}:.])(?=[A-Fa-f:]*+[0-9])[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){0,6}::"
    r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\p{L}\p{N}:])",
    # bank accounts, social security numbers, cards
    rf"{_EDGE}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",
    rf"(?<![\p{{L}}\p{{N}}-])\d{{3}}-\d{{2}}-\d{{4}}(?!-?[\p{{L}}\p{{N}}])",
    # (13 digits that start like a book's number are one)
    rf"(?<![\p{{L}}\p{{N}}+])(?!97[89]\d{{10}}(?!\d))\d{{13,19}}{_END}",
    rf"{_EDGE}\d{{4}}(?<gap>[ -])\d{{4}}\k<gap>\d{{4}}\k<gap>\d{{4}}(?:\k<gap>\d{{1,3}})?{_END}",
    rf"{_EDGE}\d{{4}}(?<gapp>[ -])\d{{6}}\k<gapp>\d{{5}}{_END}",
    # telephone numbers
    # with a plus sign, of 7 digits or more and no decimal number
    rf"(?<![\p{{L}}\p{{N}}+])\+(?!\d++[.,]\d{{1,6}}+(?!\d|[ .()-]{{1,2}}\d))"
    rf"(?!\d{{4,}}+[.,]\d{{1,6}}+(?![\d.]))"
    rf"(?:[1-9](?:[ .-]?\(?\d\)?){{6,14}}|\d{{7,23}}){_END}",
    rf"{_EDGE}\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}{_END}",
    rf"(?<![\p{{L}}\p{{N}}.-])\d{{3}}(?<dash>[ .-])\d{{3}}\k<dash>\d{{4}}(?![.-]?[\p{{L}}\p{{N}}])",
    # and of a country's own form: in pairs, after an area code, after 00
    rf"(?<![\p{{L}}\p{{N}}.,+:/-])0[1-9](?<pair>[ .-])\d{{2}}(?:\k<pair>\d{{2}}){{3}}(?![.-]?[\p{{L}}\p{{N}}])",
    r"(?<![\p{L}\p{N}.,+:/-])(?:0[1-9]\d{1,4}(?: ?/ ?|[ -])|\(0[1-9]\d{1,4}\) ?)"
    r"\d{3,4}[ -]?\d{3,5}(?![.,/:-]?[\p{L}\p{N}])",
    rf"(?<![\p{{L}}\p{{N}}.,+:/-])00[1-9]\d{{0,2}}[ .-](?:[ .-]?\(?\d\)?){{6,12}}{_END}",
    # keys and tokens
    rf"{_EDGE}(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{{32,}}+{_END}",
    rf"{_EDGE}(?:AKIA[0-9A-Z]{{16}}|gh[oprsu]_[A-Za-z0-9]{{36,}}|sk-[A-Za-z0-9]{{20,}}|{_KEY}[A-Za-z0-9]{{16,}}){_END}",
    rf"{_EDGE}eyJ[\w-]{{8,}}+\.[\w-]{{8,}}+\.[\w-]{{8,}}+",
    # the value of a password, with a digit in it; one character tells most places that are none
    rf"(?<=[=:])(?<=(?i:password|passwd|pwd).)(?={_VALUE}*\d){_VALUE}{{6,}}+",
    # names after a form of address
    rf"(?=\p{{Lu}})(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}",
)) + ")"

#: A word that may be a name, and what may follow the name in it: a genitive, a dash.
WORD = rf"{_EDGE}{_NAME}"
_SUFFIX = r"(?:['’][sS])?['’-]*$"

#: Syllables of names, per script; fixed values.
SYLLABLES = {
    "latin": "ba de fi go ha ke li mo na pe ri so ta ve wi zu".split(),
    "cyrillic": "ба де фи го ха ке ли мо на пе ри со та ве ви зу".split(),
    "greek": "βα δε φι γο χα κε λι μο να πε ρι σο τα βε θι ζυ".split(),
}
#: What a male, a female and another name ends in: surnames and names of unknown gender.
ENDINGS = {
    "latin": ("n", "a", "l"), "cyrillic": ("н", "я", "л"), "greek": ("ς", "α", "ν"),
}
MOST_ROUNDS = 50
#: After so many rounds a short format gets longer by a character with every round.
SAME_LENGTH_ROUNDS = 6


def _kind(raw: Column) -> Column:
    return (
        F.when(raw.contains("@"), "email")
        .when(raw.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(raw.rlike(r"^[0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4}){7}$|^[0-9A-Fa-f:]*::[0-9A-Fa-f:]*$"), "ipv6")
        .when(raw.rlike(rf"^(?:{_TITLE})\.? "), "name")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(raw.rlike(r"^\+|^\(|^\d{3}([ .-])\d{3}\1\d{4}$"), "phone")
        .when(raw.rlike(r"^0\d+[ ./-]") & ~raw.rlike(r"^\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}|\d{6}\1\d{5}$)"), "phone")
        .when(raw.rlike(r"^\d[\d -]+$"), "card")
        .when(raw.rlike(r"^[0-9A-Fa-f]{32,}$"), "hex")
        .when(raw.rlike(r"^[A-Z]{2}\d\d[ A-Z0-9]+$") & ~raw.startswith("AKIA"), "iban")
        .when(raw.rlike(rf"^(?:AKIA|gh[oprsu]_|sk-|{_KEY}|eyJ)"), "secret").otherwise("password")
    )


def _is_entity(raw: Column, kind: Column) -> Column:
    """A bare run of 13 to 19 digits, but for 16, is a card's only if its check digit is right."""
    bare = (kind == "card") & raw.rlike(r"^\d+$") & (F.length(raw) != 16)
    return F.when(bare, _luhn_odd(raw) % 10 == 0).otherwise(True)


def _title(raw: Column) -> Column:
    return F.regexp_extract(raw, rf"^(?:{_TITLE})\.? ", 0)


def _units(raws: DataFrame) -> DataFrame:
    """(raw, at, kind, piece, norm): what is replaced in a raw entity; a name has several pieces.

    A word of a name is one entity in whatever place and after whatever title it stands; it has the
    gender that titles tell of it as a first name, if they agree.
    """
    title = F.regexp_replace(_title(F.col("raw")), r"\.? $", "")
    gender = F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f")
    words = F.split(F.regexp_replace("raw", rf"^(?:{_TITLE})\.? ", ""), " ")
    pieces = F.when(F.col("kind") == "name", words).otherwise(F.array("raw"))
    exploded = raws.withColumn("gender", gender).select(
        "raw", "kind", "gender", F.size(pieces).alias("n"), F.posexplode(pieces).alias("at", "piece"))
    bare = F.lower(F.regexp_replace("piece", r"[^\p{L}\p{N}]", ""))
    whole = F.col("kind").isin("email", "ip", "ipv6")
    norm = (
        F.when(F.col("kind") == "name", F.lower(F.regexp_replace("piece", _SUFFIX, "")))
        .when(whole, F.lower("piece"))
        # a key's upper and lower case letters differ, but for hex digits
        .when(F.col("kind").isin("secret", "password"), F.col("piece")).otherwise(bare)
    )
    units = stored(exploded.withColumn("norm", norm), "pieces")
    told = units.where((F.col("kind") == "name") & (F.col("at") < F.col("n") - 1)).groupBy("norm").agg(
        F.min("gender").alias("one"), F.max("gender").alias("two"))
    told = told.where(F.col("one") == F.col("two")).select(F.lit("name").alias("kind"), "norm", "one")
    script = (F.when(F.col("piece").rlike(r"^\p{IsCyrillic}"), "cyrillic")
              .when(F.col("piece").rlike(r"^\p{IsGreek}"), "greek").otherwise("latin"))
    kind = F.when(F.col("kind") != "name", F.col("kind")).otherwise(
        F.concat_ws("_", F.lit("name"), F.coalesce("one", F.lit("s")), script))
    return units.join(told, ["kind", "norm"], "left").select(
        "raw", "at", kind.alias("kind"), "piece", "norm")


def _bytes(secret: str) -> Column:
    """Hex digits that depend on the key, the entity and the attempt: two for each of 256 places."""
    seed = F.concat_ws("|", F.lit(secret), "kind", "norm", F.col("attempt").cast("string"))
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 512) for i in range(4)])


def _number(hexes: Column, i: Column) -> Column:
    """The i-th byte, from 1."""
    at = ((i - 1) % 256 * 2 + 1).cast("int")
    return F.conv(hexes.substr(at, F.lit(2)), 16, 10).cast("int")


def _letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _luhn_odd(digits: Column) -> Column:
    """The Luhn sum of digits, the last one counted once."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = digits.substr(i.cast("int"), F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda a, x: a + x)


def _mod97(letters: Column) -> Column:
    """Lower-case letters and digits as a number, a letter as two digits from 10 on, modulo 97."""
    def step(a: Column, c: Column) -> Column:
        n = F.ascii(c)
        return F.when(n >= 97, (a * 100 + n - 87) % 97).otherwise((a * 10 + n - 48) % 97)

    return F.aggregate(F.filter(F.split(letters, ""), lambda c: c != ""), F.lit(0), step)


def _iban(written: Column, norm: Column) -> Column:
    """``written`` with right check digits where ``norm`` has them."""
    def turned(x: Column, check: Column) -> Column:
        return F.concat(x.substr(F.lit(5), F.length(norm)), x.substr(F.lit(1), F.lit(2)), check)

    right = _mod97(turned(norm, norm.substr(F.lit(3), F.lit(2)))) == 1
    check = F.lpad((98 - _mod97(turned(written, F.lit("00")))).cast("string"), 2, "0")
    return F.when(right, F.concat(
        written.substr(F.lit(1), F.lit(2)), check, written.substr(F.lit(5), F.length(norm)))).otherwise(written)


def _address(norm: Column, octets: list[Column]) -> Column:
    """An address of the same network if ``norm`` is in a private one, else a public one.

    A private network that is full gives way to the largest one, and that one to public addresses.
    """
    one, *others = octets
    public = one % 200 + 11
    public = F.when(public.isin(127, 169, 172, 192), public + 1).otherwise(public)
    narrow = F.col("attempt") < SAME_LENGTH_ROUNDS
    two = others[0].cast("string")
    pair = F.when(narrow & norm.startswith("192.168."), F.array(F.lit("192"), F.lit("168"))).when(
        narrow & norm.startswith("169.254."), F.array(F.lit("169"), F.lit("254"))).when(
        narrow & norm.startswith("172."), F.array(F.lit("172"), (others[0] % 16 + 16).cast("string"))).when(
        narrow & norm.startswith("127."), F.array(F.lit("127"), two)).otherwise(F.array(F.lit("10"), two))
    inside = norm.rlike(PRIVATE) & (F.col("attempt") < 3 * SAME_LENGTH_ROUNDS)
    head = F.when(inside, pair).otherwise(F.array(public.cast("string"), two))
    return F.concat_ws(".", head, *[o.cast("string") for o in others[1:]])


def _drawn(secret: str) -> Column:
    """The surrogate of an entity (kind, norm, attempt), of the length of ``norm`` but for names.

    A mail address, telephone or social security number or a password that found no free surrogate of
    its own length gets characters added, so a narrow format never runs out. Right check digits of
    cards and bank accounts stay right.
    """
    hexes, norm, kind = F.col("hexes"), F.col("norm"), F.col("kind")
    tld = F.length(F.substring_index(norm, ".", -1))

    def character(i: Column) -> Column:
        c, n = norm.substr(i.cast("int"), F.lit(1)), _number(hexes, i)
        kept = ((kind == "email") & (i > F.length(norm) - tld)) | (
            (kind == "phone") & (i == 1) & (F.length(norm) > 10)) | (
            (kind == "phone") & (i <= F.length(F.regexp_extract(norm, "^0{0,2}", 0)))) | (
            (kind == "iban") & (i <= 2)) | (
            (kind == "secret") & (i <= F.length(F.regexp_extract(norm, rf"^(?:{_KEY}|.{{4}})", 0))))
        return (
            F.when(kept, c)
            .when(c.rlike("[0-9]"), F.when(kind.isin("hex", "ipv6"), _letter("0123456789abcdef", n))
                  .otherwise((n % 10).cast("string")))
            .when(kind.isin("hex", "ipv6") & c.rlike("[a-f]"), _letter("0123456789abcdef", n))
            .when(c.rlike(r"\p{Lu}"), _letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", n))
            .when(c.rlike(r"\p{L}"), _letter("abcdefghijklmnopqrstuvwxyz", n)).otherwise(c)
        )

    places = F.sequence(F.lit(1), F.greatest(F.length(norm), F.lit(1)))
    written = F.array_join(F.transform(places, character), "")
    head = F.expr("substring(written, 1, length(written) - 1)")
    luhn = F.when(
        (kind == "card") & (_luhn_odd(norm) % 10 == 0),
        F.concat(head, ((10 - _luhn_odd(F.concat(head, F.lit("0"))) % 10) % 10).cast("string")),
    ).when(kind == "iban", _iban(F.col("written"), norm)).otherwise(F.col("written"))
    more = F.col("attempt") - SAME_LENGTH_ROUNDS + 1

    def added(j: Column) -> Column:
        n = _number(hexes, F.length(norm) + j)
        return F.when(kind == "email", _letter("abcdefghijklmnopqrstuvwxyz", n)).otherwise(
            (n % 10).cast("string"))

    longer = F.concat("written", F.array_join(F.transform(F.sequence(F.lit(1), more), added), ""))
    luhn = F.when(kind.isin("email", "phone", "ssn", "password") & (more > 0), longer).otherwise(luhn)
    groups = F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(29), F.lit(4)), lambda i: hexes.substr(i, F.lit(4))), ":")
    address = _address(norm, [_number(hexes, F.lit(i)) % 254 + 1 for i in range(1, 5)])
    # three syllables, and one more for every third attempt
    syllables = F.least(F.col("attempt") / 3, F.lit(9)).cast("int") + 3

    def name(script: str) -> Column:
        pool = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        stem = F.array_join(F.transform(
            F.sequence(F.lit(1), syllables),
            lambda i: F.element_at(pool, _number(hexes, i) % len(SYLLABLES[script]) + 1)), "")
        m, f, other = ENDINGS[script]
        return F.concat(stem, F.when(kind.startswith("name_m"), m).when(kind.startswith("name_f"), f)
                        .otherwise(other))

    names = [(kind.endswith(script), name(script)) for script in SYLLABLES]
    final = reduce(lambda rest, x: F.when(x[0], x[1]).otherwise(rest), names, luhn)
    final = F.when(kind == "ip", address).when(
        (kind == "ipv6") & norm.contains("::"), groups).otherwise(final)
    return written, final


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, norm, core) of distinct (kind, norm): no core twice in a kind, none a norm of its kind.

    A core that collides is drawn again by all but the smallest of its entities; of the rounds only
    those that collide take part, and how many there are is all that the driver learns.
    """
    waiting, done, taken = entities.withColumn("attempt", F.lit(0)), None, None
    for _ in range(MOST_ROUNDS):
        written, final = _drawn(secret)
        drawn = stored(
            waiting.withColumn("hexes", _bytes(secret)).withColumn("written", written)
            .withColumn("core", final).select("kind", "norm", "attempt", "core"), "drawn")
        real = entities.select("kind", F.col("norm").alias("core"))
        free = drawn.join(real, ["kind", "core"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "core"], "left_anti")
        owners = free.groupBy("kind", "core").agg(F.min("norm").alias("norm"))
        settled = stored(owners.select("kind", "norm", "core"), "settled")
        done = settled if done is None else done.unionByName(settled)
        taken = done.select("kind", "core")
        waiting = stored(
            drawn.join(settled.select("kind", "norm"), ["kind", "norm"], "left_anti")
            .select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "again")
        if not waiting.limit(1).count():
            return done
    raise RuntimeError("more entities of a kind than it has surrogates")


def _formatted() -> Column:
    """``core`` written like ``piece``: its punctuation, and its case letter by letter."""
    piece, core, kind = F.col("piece"), F.col("core"), F.col("kind")

    def like(i: Column) -> Column:
        c = piece.substr(i.cast("int"), F.lit(1))
        so_far = F.regexp_replace(piece.substr(F.lit(1), i.cast("int")), r"[^\p{L}\p{N}]", "")
        at = F.when(kind.isin("email", "ipv6"), i.cast("int")).otherwise(F.length(so_far))
        new = core.substr(at, F.lit(1))
        new = F.when((kind != "secret") & c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)
        # a letter for a hex digit takes the case of the whole
        new = F.when(kind.isin("hex", "ipv6") & (F.upper(piece) == piece), F.upper(new)).otherwise(new)
        return F.when(c.rlike(r"[\p{L}\p{N}]") | (kind == "email"), new).otherwise(c)

    written = F.array_join(F.transform(F.sequence(F.lit(1), F.length(piece)), like), "")
    beyond = F.expr("substring(core, length(norm) + 1)")
    written = F.when(kind == "email", F.concat(beyond, written)).otherwise(F.concat(written, beyond))
    capital = F.concat(F.upper(F.substring(core, 1, 1)), F.expr("substring(core, 2)"))
    suffix = F.regexp_extract(piece, _SUFFIX, 0)
    bare = F.regexp_replace(piece, _SUFFIX, "")
    all_upper = (F.upper(bare) == bare) & (F.length(bare) > 1)
    name = F.concat(F.when(all_upper, F.upper(core)).otherwise(capital), suffix)
    has_letters = (F.upper(piece) == piece) & piece.rlike("[A-F]")
    return (
        F.when(kind.startswith("name"), name)
        .when((kind == "ipv6") & piece.contains("::"), F.when(has_letters, F.upper(core)).otherwise(core))
        .when(kind.isin("ip", "secret", "password"), core).otherwise(written)
    )


def replacements(raws: DataFrame, secret: str) -> DataFrame:
    """(raw, kind, surrogate, words) of distinct raw entities; ``words`` are (norm, core) of a name.

    What looks like an entity and is none has no row."""
    kinds = raws.select("raw", _kind(F.col("raw")).alias("kind")).where(_is_entity(F.col("raw"), F.col("kind")))
    units = stored(_units(kinds), "units")
    cores = surrogates(stored(units.select("kind", "norm").distinct(), "entities"), secret)
    pieces = units.join(cores, ["kind", "norm"]).select(
        "raw", "at", F.split("kind", "_")[0].alias("kind"), _formatted().alias("new"), "norm", "core")
    made = pieces.groupBy("raw").agg(
        F.min("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("at", "new", "norm", "core"))).alias("p"))
    # an initial or a pronoun is no name by itself
    words = F.filter(F.when(F.col("kind") == "name", F.col("p")), lambda p: F.length(p["norm"]) > 1)
    new = F.array_join(F.transform("p", lambda p: p["new"]), " ")
    return made.select(
        "raw", "kind",
        F.concat(F.when(F.col("kind") == "name", _title(F.col("raw"))).otherwise(""), new).alias("surrogate"),
        F.transform(words, lambda p: F.struct(p["norm"].alias("norm"), p["core"].alias("core"))).alias("words"))


def _again(word: Column, names: Column, gap: Column) -> Column:
    """(kind, surrogate) of a word after ``gap`` that is a name of its text, null of another."""
    bare, suffix = F.regexp_replace(word, _SUFFIX, ""), F.regexp_extract(word, _SUFFIX, 0)
    core = names[F.lower(bare)]
    new = F.when(F.upper(bare) == bare, F.upper(core)).otherwise(
        F.concat(F.upper(F.substring(core, 1, 1)), F.substring(core, 2, 1000)))
    other = gap.rlike(rf"(?i){_EDGE}(?:{'|'.join(ARTICLES)})\s+$") | (
        F.lower(bare).isin(*MONTHS) & gap.rlike(rf"(?i){_EDGE}(?:{'|'.join(BEFORE_MONTHS)})\s+$"))
    return F.when(core.isNotNull() & ~F.coalesce(other, F.lit(False)),
                  F.struct(F.lit("name").alias("kind"), F.concat(new, suffix).alias("surrogate")))


def _marked(docs: DataFrame, secret: str, text: str) -> DataFrame:
    """(doc, text, pii): a row of ``docs`` as a struct, its text with surrogates, and these in order."""
    old = F.col(f"doc.`{text}`")
    # whatever the columns are called, they clash with none of this function's
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumns(
        {"one": F.xxhash64(F.lit(1), old), "two": F.xxhash64(F.lit(2), old)})
    found = F.regexp_extract_all(old, F.lit(PATTERN), F.lit(0))
    mentions = stored(
        hashed.select("one", "two", F.explode(F.array_distinct(found)).alias("raw")).distinct(), "mentions")
    new = stored(replacements(mentions.select("raw").distinct(), secret), "replacements")
    words = F.array_distinct(F.flatten(F.collect_list("words")))
    # stored, so that the join's sides come from exchanges alone and AQE splits a text of many copies
    maps = stored(mentions.join(new, "raw").groupBy("one", "two").agg(
        F.map_from_entries(F.collect_list(F.struct("raw", F.struct("kind", "surrogate")))).alias("map"),
        F.when(F.size(words) > 0, F.map_from_entries(words)).alias("names")), "maps")
    # by its hashes, since the map's side is small now and may not be later
    joined = hashed.join(maps.hint("merge"), ["one", "two"], "left")
    marks = F.transform(found, lambda raw: F.col("map")[raw])
    filling = F.transform(found, lambda raw: F.coalesce(F.col("map")[raw]["surrogate"], raw))
    between = F.split(old, PATTERN, -1)
    # in texts with names also the words between the entities
    names = F.col("names")

    def in_between(b: Column) -> Column:
        bare = F.regexp_extract_all(b, F.lit(WORD), F.lit(0))
        return F.array_join(F.zip_with(F.split(b, WORD, -1), bare, lambda gap, w: F.concat(
            gap, F.coalesce(_again(w, names, gap)["surrogate"], w, F.lit("")))), "")

    def marks_between(b: Column, m: Column) -> Column:
        bare = F.regexp_extract_all(b, F.lit(WORD), F.lit(0))
        new = F.zip_with(F.split(b, WORD, -1), bare, lambda gap, w: _again(w, names, gap))
        return F.concat(new, F.array(m))

    filled = F.when(names.isNotNull(), F.zip_with(
        between, filling, lambda b, m: F.concat(in_between(b), F.coalesce(m, F.lit("")))),
    ).otherwise(F.zip_with(between, filling, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))))
    marks = F.when(names.isNotNull(), F.flatten(F.zip_with(between, marks, marks_between))).otherwise(marks)
    none = F.expr("cast(array() as array<struct<kind: string, surrogate: string>>)")
    has = F.col("map").isNotNull()
    return joined.select(
        "doc", F.when(has, F.array_join(filled, "")).otherwise(old).alias("text"),
        F.when(has, F.filter(marks, lambda x: x.isNotNull())).when(old.isNotNull(), none).alias("pii"),
    )


def pseudonymize(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and one more column, ``pii``, (kind, surrogate) in order.

    A null text stays null with null ``pii``; a text without entities stays as it is with an empty
    ``pii``; repeated rows change alike; an empty table gives an empty one; a column ``pii`` of the
    input is replaced, other columns may have any names. Texts are joined with their entities by two
    hashes of the text, so rows need no key, and copies share the work; a text that a third of all rows
    hold is a skewed equi-join of stored tables, which AQE splits. Nothing but counts reaches the driver.
    """
    return _marked(docs, secret, text).select(
        *[F.col("text" if c == text else f"doc.`{c}`").alias(c) for c in docs.columns if c.lower() != "pii"], "pii")


def replace(docs: DataFrame, secret: str, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with surrogates in ``text``, the columns they came with, and ``n_chars`` counted anew
    where a text changed."""
    def column(c: str) -> Column:
        if c == text:
            return F.col("text").alias(c)
        if c == n_chars:
            return F.when(F.size("pii") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(
                F.col(f"doc.`{c}`")).alias(c)
        return F.col(f"doc.`{c}`").alias(c)

    return _marked(docs, secret, text).select(*[column(c) for c in docs.columns])
