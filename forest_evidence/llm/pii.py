"""Surrogates for personal data (operator 2); DataFrame and SQL functions only.

Patterns detect entities. An entity's identity is its type and canonical form (national digits of a phone,
lower case of an address, one word of a name), so that all its spellings get one surrogate. A keyed hash
draws the surrogate: each digit becomes a digit, each letter a letter of its script, a name one of the same
gender and script; card numbers keep their check digit valid, account numbers theirs.
All surrogates of the corpus are checked: none may equal another's or a real entity of its type; those
that do are drawn again, names and addresses with a syllable more. Each mention is then written in the form
it had; names that a document mentions are replaced where they stand alone too.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, free_name, staged

#: Session setting with the secret key of the surrogates, and what stands for it in tests.
KEY_SETTING, TEST_KEY = "spark.forest_evidence.surrogateKey", "not a secret"
#: Draws at which a surrogate keeps its form's length; after them numbers get a digit more at each draw. Short
#: addresses of the sixth version, which have few spellings, are drawn as whole ones from draw WHOLE on.
DRAWS, WHOLE = 12, 2

# Forms of address by gender, and given names that mark a name without one.
MALE_TITLES = "Mr Mister Herr Monsieur Señor Sr г-н".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Mme Señora Sra г-жа".split()
OTHER_TITLES = "Dr Prof Professor".split()
MALE_NAMES = "James John Robert Michael William David Richard Thomas Peter Paul Hans Klaus Jürgen Pierre Jean Jacques Carlos José Juan Luis Иван Сергей Дмитрий".split()
FEMALE_NAMES = "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Sarah Anna Julia Ursula Monika Marie Claire Sophie Carmen María Lucía Isabel Elena Мария Анна Ольга".split()
LATIN_SYLLABLES = "ba be bo da de do fa fe fi ga ge ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ri ro ta".split()
CYRILLIC_SYLLABLES = "ба бе бо да де до фа фе фи га ге ка ке ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро та".split()

#: A capitalised word; an apostrophe belongs to it before a letter, but for a last "'s".
_WORD = r"\p{Lu}(?:[\p{L}-]|['’](?=\p{L})(?![sS](?![\p{L}\p{N}])))+"
_ALONE = rf"(?<![\p{{L}}\p{{N}}]){_WORD}"
_TITLES = "|".join([*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES])
#: In capitals, a title needs its full stop ("MISS" is a word of shouted prose), a given name a word in capitals behind it.
_CAPITAL_TITLES = "|".join(t.upper() for t in [*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES])
_GIVEN = "|".join([*MALE_NAMES, *FEMALE_NAMES]) + "|(?:" + "|".join(n.upper() for n in [*MALE_NAMES, *FEMALE_NAMES]) + r")(?= \p{Lu}{2})"
#: type -> pattern; the first that matches at a place counts.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "token": r"(?<![\p{L}\p{N}])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|sk-[0-9A-Za-z_-]{20,}|gh[opsu]_[0-9A-Za-z]{30,})(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])",
    "ip6": r"(?<![\p{L}\p{N}:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<![\p{L}\p{N}+.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.])\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?=[\p{{Lu}}г])(?:(?:(?:{_TITLES})\.?|(?:{_CAPITAL_TITLES})\.)(?: {_WORD}){{1,2}}|(?:{_GIVEN}) {_WORD})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without a match of this can't hold an entity. Titles and names begin with a capital or as "г-н" does, which
#: spares trying them all at every other character.
HINT = rf"[@\d:]|(?=[\p{{Lu}}г])(?:{_TITLES}|(?:{_CAPITAL_TITLES})\.|{_GIVEN})"


def _type(m: Column) -> Column:
    out = F.lit("name")
    for kind, p in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        out = F.when(m.rlike(f"^(?:{p})$"), kind).otherwise(out)
    return out


def _parts(m: Column) -> Column:
    """The identities in a mention: array of struct(kind, form, gender). A name has one for each word but its
    title; a given name's gender is that of the listed name, else its title's."""
    kind = _type(m)
    words = F.split(m, " ")
    plain = lambda w: F.when((F.upper(w) == w) & (F.length(w) > 1), F.initcap(w)).otherwise(w)
    first = plain(F.regexp_replace(words[0], r"\.$", ""))
    of_title = F.when(first.isin(*MALE_TITLES), "male").when(first.isin(*FEMALE_TITLES), "female")
    title = first.isin(*MALE_TITLES, *FEMALE_TITLES, *OTHER_TITLES)
    size = F.size(words)

    def one(w: Column, i: Column) -> Column:
        role = F.when((i == 0) & title, "title").when(i == size - 1, "family").otherwise("given")
        gender = F.when(plain(w).isin(*MALE_NAMES), "male").when(plain(w).isin(*FEMALE_NAMES), "female").otherwise(of_title)
        return F.struct(role.alias("kind"), F.lower(w).alias("form"), F.when(role == "given", gender).alias("gender"))

    digits = F.regexp_replace(m, r"\D", "")
    phone = F.when(m.startswith("+1") & (F.length(digits) == 11), F.substr(digits, F.lit(2))).otherwise(digits)
    bare = (
        F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.replace(m, F.lit(" "), F.lit(""))).when(kind == "token", m).otherwise(F.lower(m))
    )
    alone = F.array(F.struct(kind.alias("kind"), bare.alias("form"), F.lit(None).cast("string").alias("gender")))
    return F.when(kind == "name", F.transform(words, one)).otherwise(alone)


def _draws(key: str, kind: Column, form: Column, draw: Column) -> Column:
    """256 hexadecimal digits for an identity."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, form, draw.cast("string"))
    return F.concat(F.sha2(F.concat(F.lit("a"), seed), 512), F.sha2(F.concat(F.lit("b"), seed), 512))


def _number(stream: Column, i: Column) -> Column:
    """A number below 65536 for place i (from 0) of a stream; each time round it is read from one digit further on."""
    return F.conv(F.substr(stream, F.pmod(i * 4 + F.floor(i / 63).cast("int"), F.lit(252)) + 1, F.lit(4)), 16, 10).cast("int")


def _like(form: Column, stream: Column, kept: Column) -> Column:
    """Every digit a digit, every letter a letter of its case and script; the first ``kept`` characters stay."""
    tables = [(r"[0-9]", "0123456789"), (r"[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшыэюя"), (r"\p{L}", "abcdefghijklmnopqrstuvwxyz")]
    n = F.length(form)

    def one(i: Column) -> Column:
        c = F.substr(form, i, F.lit(1))
        v = _number(stream, i)
        new = F.when(i <= kept, c)
        for pattern, table in tables:
            new = new.when(c.rlike(pattern), F.substr(F.lit(table), v % len(table) + 1, F.lit(1)))
        return new.otherwise(c)

    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), one), "")).otherwise(form)


def _characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def luhn_digit(body: Column) -> Column:
    """The check digit that follows the digits of a card number."""
    digits = F.transform(F.reverse(_characters(body)), lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(c.cast("int") * 2))
    total = F.aggregate(digits, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return F.pmod(-total, F.lit(10)).cast("string")


def iban_check(country: Column, account: Column) -> Column:
    """The two check digits of an account number."""
    step = lambda s, c: F.when(c.rlike("[0-9]"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)
    rest = F.aggregate(_characters(F.concat(account, country, F.lit("00"))), F.lit(0), lambda s, c: F.coalesce(step(s, c), F.lit(0)).cast("int"))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _kept(kind: Column, form: Column) -> Column:
    """How many of its first characters a surrogate keeps."""
    n = F.length(form)
    mark = F.when(form.startswith("sk-"), 3).otherwise(4)
    return F.when(kind == "card", 1).when(kind == "phone", F.greatest(F.lit(0), n - 10)).when(kind == "iban", 2).when(kind == "token", mark).otherwise(0)


def surrogate(key: str, kind: Column, form: Column, gender: Column, draw: Column) -> Column:
    """The surrogate of an identity at a draw, in canonical form. Each draw has a syllable more in names and
    addresses, numbers have a digit more at each draw from DRAWS on, and addresses of the sixth version have
    all their groups from WHOLE on, so that there are more spellings than identities from some draw on."""
    stream = _draws(key, kind, form, draw)
    octets = F.array_join(F.array(*[(_number(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)]), ".")
    n = F.length(form)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / 128).cast("int")), lambda i: F.sha2(F.concat_ws("\x1f", stream, i.cast("string")), 512))
    hexes = F.when(n > 0, F.substr(F.array_join(blocks, ""), F.lit(1), n))
    ip6 = F.array_join(F.transform(_characters(form), lambda c, i: F.when(c == ":", c).otherwise(F.substr(stream, F.pmod(i, F.lit(256)) + 1, F.lit(1)))), "")
    groups = [F.concat(F.lit("fd"), F.substr(stream, F.lit(1), F.lit(2))), *[F.substr(stream, F.lit(4 * k), F.lit(4)) for k in range(1, 8)]]
    ip6 = F.when(draw < WHOLE, ip6).otherwise(F.concat_ws(":", *groups))
    cyrillic = form.rlike(r"\p{IsCyrillic}")

    def syllables(table: list[str], least: int) -> Column:
        names = F.array(*map(F.lit, table))
        return F.array_join(F.transform(F.sequence(F.lit(0), draw + (least - 1)), lambda i: F.element_at(names, _number(stream, i) % len(table) + 1)), "")

    woman, man = F.when(cyrillic, "на").otherwise("na"), F.when(cyrillic, "н").otherwise("n")
    name = F.when(cyrillic, syllables(CYRILLIC_SYLLABLES, 4)).otherwise(syllables(LATIN_SYLLABLES, 4))
    name = F.concat(name, F.when(gender == "female", woman).when(gender == "male", man).otherwise(""))
    mail = F.concat(_like(F.substring_index(form, "@", 1), stream, F.lit(0)), F.lit("@"), syllables(LATIN_SYLLABLES, 3), F.lit(".example."), F.substring_index(form, ".", -1))
    more = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), draw - DRAWS + 1)), lambda i: (_number(stream, n + i) % 10).cast("string"))
    like = _like(form, stream, _kept(kind, form))
    like = F.when((draw >= DRAWS) & kind.isin("card", "phone", "ssn", "iban", "token"), F.concat(like, F.array_join(more, ""))).otherwise(like)
    body = F.substr(like, F.lit(1), F.length(like) - 1)
    account = F.substr(like, F.lit(5))
    country = F.substr(form, F.lit(1), F.lit(2))
    return (
        F.when(kind == "title", form).when(kind == "email", mail).when(kind == "ip", octets).when(kind == "ip6", ip6).when(kind == "secret", hexes)
        .when(kind.isin("family", "given"), name).when((kind == "card") & (n > 1), F.concat(body, luhn_digit(body)))
        .when(kind == "iban", F.concat(country, iban_check(country, account), account)).otherwise(like)
    )


def assigned(found: DataFrame, key: str) -> DataFrame:
    """kind, form, surrogate for the distinct identities in ``found(kind, form, gender)``. A name that is given
    two genders has the first by name.

    No two identities of a kind share a surrogate and none is a real form of its kind. In a clash the
    smallest form keeps the surrogate and the others draw again, until all have one; as each kind's room
    grows with the draws, that comes to an end whatever the forms are.
    """
    real = staged(found.where("kind <> 'title'").groupBy("kind", "form").agg(F.min("gender").alias("gender")))
    left, taken = real, None
    for draw in count():
        drawn = left.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("form"), F.col("gender"), F.lit(draw)))
        used = real.select("kind", F.col("form").alias("surrogate"))
        if taken is not None:
            used = used.union(taken.select("kind", "surrogate"))
        free = drawn.join(used, ["kind", "surrogate"], "left_anti")
        good = staged(free.groupBy("kind", "surrogate").agg(F.min("form").alias("form")).select("kind", "form", "surrogate"))
        taken = good if taken is None else taken.union(good)
        rest = left.join(good, ["kind", "form"], "left_anti")
        if rest.isEmpty():
            return taken
        left = staged(rest)


def _written_name(word: Column, new: Column) -> Column:
    """A name in the case of the word that it replaces."""
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(new)).otherwise(F.initcap(new))


def _as_written(m: Column, get) -> Column:
    """A mention rewritten with the surrogates of its identities, in its own format and case."""
    kind = _type(m)
    parts = _parts(m)
    new = get(parts[0])
    signs = F.regexp_replace(m, "[^A-Z0-9]", "")
    padded = F.concat(F.substr(signs, F.lit(1), F.greatest(F.lit(0), F.length(signs) - F.length(parts[0]["form"]))), new)  # a country code stays
    digits = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(m)),
            lambda i: F.when(F.substr(m, i, F.lit(1)).rlike("[A-Z0-9]"), F.substr(padded, F.length(F.regexp_replace(F.substr(m, F.lit(1), i), "[^A-Z0-9]", "")), F.lit(1))).otherwise(F.substr(m, i, F.lit(1))),
        ),
        "",
    )
    words = F.split(m, " ")
    digits = F.concat(digits, F.substr(padded, F.length(signs) + 1))  # of a surrogate that is longer than its form
    names = F.array_join(F.zip_with(words, parts, lambda w, p: F.when(p["kind"] == "title", w).otherwise(_written_name(w, get(p)))), " ")
    cased = F.when((F.upper(m) == m) & m.rlike(r"\p{L}"), F.upper(new)).otherwise(new)
    return F.when(kind.isin("card", "ssn", "phone", "iban"), digits).when(kind == "name", names).when(kind == "token", new).otherwise(cased)


def session_key(spark: SparkSession) -> str:
    """The session's key; one for tests, which keeps nothing secret, where none is set."""
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """All rows and columns of ``docs`` with personal data in ``text`` replaced, and n_entities (mentions).

    Null and empty texts stay. doc_id may be null or repeat: what is found under one doc_id is looked up
    together. A column n_entities of ``docs`` is replaced, any other keeps its name and values. Texts are
    searched whole, whatever their length. Texts move only to meet the surrogates of their
    own mentions, and not even then while these are small enough to broadcast. An empty table gives no rows.
    """
    mine, id_, hits_ = (free_name(docs, n) for n in ("own_surrogates", "surrogates_id", "surrogates_hits"))
    hits = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    found = docs.select("doc_id", hits.alias("hits")).where(F.size("hits") > 0)
    found = found.select("doc_id", F.explode(F.array_distinct(F.flatten(F.transform("hits", _parts)))).alias("part"))
    found = staged(found.select("doc_id", "part.kind", "part.form", "part.gender").distinct())
    table = assigned(found, key)
    place = F.concat_ws(":", "kind", "form")
    own = found.join(table, ["kind", "form"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct(place, "surrogate"))).alias(mine))
    own = staged(own.withColumnRenamed("doc_id", id_))
    size = own.agg(F.sum(F.length(F.array_join(F.map_keys(mine), "")) * 3 + F.size(mine) * 48 + 64)).first()[0] or 0
    own = F.broadcast(own) if size <= BROADCAST_BYTES else own
    both = docs.drop("n_entities").join(own, F.col("doc_id").eqNullSafe(F.col(id_)), "left")
    look = lambda kind, form: F.element_at(F.col(mine), F.concat_ws(":", kind, form))
    mentions = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    named = F.exists(F.map_keys(mine), lambda k: k.startswith("family:") | k.startswith("given:"))

    def alone(piece: Column) -> Column:
        """Names of the document's own people where they stand alone."""
        words = F.regexp_extract_all(piece, F.lit(_ALONE), F.lit(0))
        known = lambda w: F.coalesce(look(F.lit("family"), F.lower(w)), look(F.lit("given"), F.lower(w)))
        new = F.transform(words, lambda w: F.coalesce(_written_name(w, known(w)), w))
        return F.array_join(F.zip_with(F.split(piece, _ALONE, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")

    between = F.split("text", ANY, -1)
    between = F.when(named, F.transform(between, alone)).otherwise(between)
    text = F.array_join(F.zip_with(between, F.transform(F.col(hits_), lambda m: _as_written(m, lambda p: look(p["kind"], p["form"]))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    both = both.withColumn(hits_, F.when(F.col(mine).isNotNull(), mentions))
    changed = F.coalesce(F.size(hits_), F.lit(0)) > 0
    out = both.withColumn("n_entities", F.when(changed, F.size(hits_)).otherwise(0)).withColumn("text", F.when(changed, text).otherwise(F.col("text")))
    return out.select(*[c for c in docs.columns if c != "n_entities"], "n_entities")
