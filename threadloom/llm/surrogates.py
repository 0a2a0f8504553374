"""Personal data replaced by keyed, type-consistent surrogates, with DataFrame functions only.

Each detected entity is reduced to its type and a canonical value (coreference: the same person, number
or address anywhere in the corpus has the same one). Names that stand with a title somewhere are also found where they stand without one. A keyed digest of both selects the surrogate, which
keeps the format: digits for digits, letters for letters in their case, separators in place; valid card
numbers stay valid; names keep title, gender, script and number of parts. Surrogates of the whole corpus
are compared with each other and with all originals; where two entities meet, all but the first take the
digest's next attempt until every surrogate is distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.scratch import Scratch
from threadloom.session import broadcast_if_small

# --- fixed values: titles by gender, and parts of names by script and gender -------------------
TITLES = {
    "f": "Mrs Ms Miss Madam Frau Mme Madame Mlle Sra Señora Srta Signora г-жа госпожа",
    "m": "Mr Sir Herr Monsieur Sr Señor Signor г-н господин",
    "n": "Dr Prof",
}
GIVEN = {
    "latin": {
        "f": "Anna Clara Elena Emma Julia Laura Lucia Maria Nora Olivia Paula Rosa Sara Sofia Teresa Vera",
        "m": "Adam Bruno Daniel David Felix Hugo Jonas Karl Leo Lucas Marco Martin Oscar Paul Simon Victor",
        "n": "Alex Andrea Charlie Dominique Eden Kim Lee Noel Quinn Robin Sacha Sam Sascha Sidney Toni Yael",
    },
    "cyrillic": {
        "f": "Анна Вера Дарья Елена Зоя Ирина Лидия Мария Нина Ольга Раиса Софья Тамара Ульяна Юлия Яна",
        "m": "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Юрий",
        "n": "Валя Женя Саша Слава Шура Паша Миша Люда Тоня Витя Толя Рита Лида Поля Гриша Даня",
    },
}
SYLLABLES = {
    "latin": "ba den far gol han ker lin mar nel por ran sol tan vel win zor",
    "cyrillic": "ба дан зор кар лен мир нов пол рад сол тер вал хар чер шин гор",
}
#: Lower-case parts of surnames, which surrogates keep.
PARTICLES = "von van der den de del della di da do dos du la le ten ter zu zum zur af av bin ibn"
#: Country codes of one and two digits; all others have three.
COUNTRY_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ENDINGS = {"latin": {"f": "er", "m": "er", "n": "er"}, "cyrillic": {"f": "ова", "m": "ов", "n": "ко"}}
# --------------------------------------------------------------------------------------------

def _title(names: str) -> str:
    """An expression of titles, also in upper case."""
    forms = dict.fromkeys(form for t in names.split() for form in (t, t.upper()))
    return "(?:" + "|".join(t.replace("-", "\\-") for t in forms) + ")"


_TITLE = {g: _title(names) for g, names in TITLES.items()}
_ANY_TITLE = "(?:" + "|".join(_TITLE.values()) + ")"
_INITIALS = "".join(sorted({form for names in TITLES.values() for t in names.split() for form in (t[0], t[0].upper())}))
_PARTICLE = "(?:" + "|".join(PARTICLES.split()) + "|" + "|".join(PARTICLES.upper().split()) + ")"
#: A part of a name, which is no title, and whole names of any number of parts.
_NAME = f"(?!{_ANY_TITLE}[ .])\\p{{Lu}}[\\p{{L}}'’-]++(?!\\p{{N}})"
_FULL = f"(?:{_PARTICLE} )*+{_NAME}(?: (?:{_PARTICLE} )*+{_NAME})*+"
_SEVERAL = f"{_NAME}(?: (?:{_PARTICLE} )*+{_NAME})++"
#: Expressions of the entity types, in order of precedence. Each starts at a border, so a scan is linear.
TYPES = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){0,8}\\.[A-Za-z]{2,24}",
    "iban": "(?<![A-Za-z0-9])[A-Z]{2}\\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "card": "(?<![A-Za-z0-9])(?:\\d{13,19}|\\d{4}[ -]\\d{4}[ -]\\d{4}[ -]\\d{1,7})(?![A-Za-z0-9])",
    "ssn": "(?<![A-Za-z0-9-])\\d{3}-\\d{2}-\\d{4}(?![A-Za-z0-9-])",
    "phone": "(?:(?<![A-Za-z0-9])\\+\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)[ .-]?)?\\d{2,5}(?:[ .-]?\\d{2,5}){1,4}"
             "|(?<![A-Za-z0-9])\\(\\d{3}\\) ?\\d{3}[.-]\\d{4}|(?<![A-Za-z0-9.-])\\d{3}[.-]\\d{3}[.-]\\d{4}"
             "|(?<![A-Za-z0-9./-])0[1-9]\\d{1,3}[ /-]\\d{5,9})(?![A-Za-z0-9])",
    "ip": "(?<![A-Za-z0-9.])(?:(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)\\.){3}(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)(?![A-Za-z0-9])(?!\\.\\d)",
    "person": f"(?=[{_INITIALS}])(?<![\\p{{L}}\\p{{N}}]){_ANY_TITLE}\\.? {_FULL}",
    # no entity of its own: names with a title elsewhere are looked up in it
    "name": f"(?=\\p{{Lu}})(?<![\\p{{L}}\\p{{N}}'’-]){_SEVERAL}",
}
PATTERN = "|".join(f"(?:{p})" for p in TYPES.values())
#: Every type but names needs one of these; the expression of names alone is a cheaper scan.
SIGNS = "[0-9@]"
NAMES = "|".join(f"(?:{TYPES[kind]})" for kind in ("person", "name"))
#: Attempts after which the key is refused. Names grow longer, so only numbers that fill their format can reach it.
MAX_ATTEMPTS = 64


def entity_type(match: Column) -> Column:
    """Type of a whole match; the first expression that fits it."""
    chosen = F.lit("name")
    for name, pattern in reversed(list(TYPES.items())):
        # borders were checked in the text
        inner = pattern
        chosen = F.when(match.rlike(f"^(?:{inner})$"), F.lit(name)).otherwise(chosen)
    return chosen


def canonical(kind: Column, match: Column) -> Column:
    """What identifies an entity whatever its spelling: numbers without separators, folded addresses, names without title."""
    squeezed = F.regexp_replace(match, "[^\\p{L}\\p{N}]", "")
    name = F.regexp_replace(match, f"^{_ANY_TITLE}\\.? ", "")
    dialled = F.regexp_replace(match, "[^0-9+]", "")
    return (F.when(kind == "email", F.lower(match)).when(kind == "ip", match).when(kind == "person", F.lower(name))
            .when(kind == "phone", dialled).otherwise(squeezed))


def _gender(match: Column) -> Column:
    chosen = F.lit("n")
    for gender in ("f", "m"):
        chosen = F.when(match.rlike(f"^{_TITLE[gender]}\\.? "), F.lit(gender)).otherwise(chosen)
    return chosen


def _byte(digest: Column, i) -> Column:
    """The i-th byte of a hexadecimal digest, from 0, round after round."""
    place = (F.lit(i) if isinstance(i, int) else i) % 32
    return F.conv(F.substring(digest, (place * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _reshape(text: Column, digest: Column, letters: bool, keep: Column) -> Column:
    """Replaces digits (and letters) by keyed ones from place ``keep`` on; all else stays."""
    def one(char, i):
        value = _byte(digest, i)
        out = F.when(char.rlike("^[0-9]$"), (value % 10).cast("string"))
        if letters:
            out = out.when(char.rlike("^[a-z]$"), F.char(97 + value % 26)).when(char.rlike("^[A-Z]$"), F.char(65 + value % 26))
        return F.when(i < keep, char).otherwise(out.otherwise(char))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    def add(acc, pair):
        return acc + pair

    def weighted(char, i):
        value = char.cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(F.split(digits, ""), weighted), F.lit(0), add) % 10


def _card(plain: Column, digest: Column) -> Column:
    """A number of the same length and first digit that passes the Luhn test if the original does."""
    body = _reshape(plain, digest, False, F.lit(1))
    head = F.substring(body, F.lit(1), F.length(body) - 1)
    check = (F.lit(10) - _luhn(F.concat(head, F.lit("0")))) % 10
    return F.when(_luhn(plain) == 0, F.concat(head, check.cast("string"))).otherwise(body)


def _remainder(text: Column) -> Column:
    """The number that digits and letters (A is 10) spell, modulo 97."""
    def add(acc, char):
        return F.when(char.rlike("[0-9]"), acc * 10 + F.ascii(char) - 48).otherwise(acc * 100 + F.ascii(F.upper(char)) - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(plain: Column, digest: Column) -> Column:
    """The same country and format; check digits that hold if those of the original do."""
    body = F.substring(_reshape(plain, digest, True, F.lit(4)), F.lit(5), F.length(plain))
    country = F.substring(plain, 1, 2)
    check = F.lpad((98 - _remainder(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    valid = _remainder(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1
    return F.when(valid, F.concat(country, check, body)).otherwise(_reshape(plain, digest, True, F.lit(2)))


def _pick(words: str, value: Column) -> Column:
    options = F.array(*[F.lit(w) for w in words.split()])
    return F.element_at(options, (value % len(words.split()) + 1).cast("int"))


def _person(plain: Column, gender: Column, digest: Column, attempt: Column) -> Column:
    """Given name by gender, middle names and a surname of syllables, in the script of the original, with its particles.

    Later attempts have longer surnames.
    """
    cyrillic = plain.rlike("\\p{IsCyrillic}")
    parts = F.split(plain, " ")

    def in_script(script: str) -> Column:
        given, ending = F.lit(""), F.lit("")
        for g in ("n", "m", "f"):
            drawn, other = (_pick(GIVEN[script][g], _byte(digest, 0) + i) for i in (0, 1))
            # never the given name that is replaced
            given = F.when(gender == g, F.when(F.lower(drawn) == F.get(parts, F.lit(0)), other).otherwise(drawn)).otherwise(given)
            ending = F.when(gender == g, F.lit(ENDINGS[script][g])).otherwise(ending)
        length = F.least(attempt / 2, F.lit(20)).cast("int") + 3
        stem = F.array_join(F.transform(F.sequence(F.lit(1), length), lambda i: _pick(SYLLABLES[script], _byte(digest, i))), "")
        surname = F.initcap(F.concat(stem, ending))

        def part(word, i):
            middle = F.initcap(F.concat(_pick(SYLLABLES[script], _byte(digest, i + 29)), _pick(SYLLABLES[script], _byte(digest, i + 30))))
            return F.when(i == F.size(parts) - 1, surname).when(word.isin(PARTICLES.split()), word).when(i == 0, given).otherwise(middle)

        return F.array_join(F.transform(parts, part), " ")

    return F.when(cyrillic, in_script("cyrillic")).otherwise(in_script("latin"))


def surrogate_value(kind: Column, plain: Column, gender: Column, attempt: Column, key: str) -> Column:
    """The canonical value of the surrogate of an entity."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, plain, gender, attempt.cast("string")), 256)
    local, domain = F.substring_index(plain, "@", 1), F.substring_index(plain, "@", -1)
    # all addresses of a domain keep a common one
    of_domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256)
    host = F.regexp_replace(domain, "\\.[a-z]+$", "")
    email = F.concat(_reshape(local, digest, True, F.lit(0)), F.lit("@"), _reshape(host, of_domain, True, F.lit(0)), F.lit(".example"))
    octet = lambda i: _byte(digest, i)
    ip = F.concat_ws(".", (octet(0) % 223 + 1).cast("string"), *[octet(i).cast("string") for i in (1, 2, 3)])
    return (F.when(kind == "email", email).when(kind == "card", _card(plain, digest)).when(kind == "ip", ip)
            .when(kind == "person", _person(plain, gender, digest, attempt)).when(kind == "iban", _iban(plain, digest))
            # the country code, or the zero that stands for it, stays
            .otherwise(_reshape(plain, digest, False, F.length(F.regexp_extract(plain, f"^(?:\\+(?:{COUNTRY_CODES}|\\d{{3}})|0)", 0)))))


def spelled(kind: Column, match: Column, value: Column) -> Column:
    """The surrogate in the spelling of a mention: its separators, its title, its case."""
    plain = F.regexp_replace(value, "[^\\p{L}\\p{N}]", "")

    def place(char, i):
        before = F.regexp_replace(F.substring(match, F.lit(1), i), "[^\\p{L}\\p{N}]", "")
        return F.when(char.rlike("^[\\p{L}\\p{N}]$"), F.substring(plain, F.length(before) + 1, F.lit(1))).otherwise(char)

    number = F.array_join(F.transform(F.split(match, ""), place), "")
    title = F.regexp_extract(match, f"^({_ANY_TITLE}\\.? )", 1)
    name = F.substring(match, F.length(title) + 1, F.length(match))
    upper = F.when(match == F.upper(match), F.upper(value)).otherwise(value)
    return F.when(kind == "person", F.concat(title, F.when(name == F.upper(name), F.upper(value)).otherwise(value))).when(kind == "email", upper).when(kind == "ip", value).otherwise(number)


def _mentions(found: DataFrame) -> DataFrame:
    each = found.select("doc_id", "text_key", F.posexplode("matches").alias("place", "match"))
    typed = each.withColumn("kind", entity_type(F.col("match")))
    return typed.withColumn("plain", canonical(F.col("kind"), F.col("match"))).withColumn("gender", _gender(F.col("match")))


def identities(mentions: DataFrame) -> DataFrame:
    """(kind, plain, gender, identity): which gender stands for an entity of this spelling and title.

    A title without gender takes the only one that stands with the name elsewhere. Where titles of both genders
    stand with it, there are two persons, and a third for titles without gender.
    """
    known = mentions.groupBy("kind", "plain").agg(F.collect_set(F.when(F.col("gender") != "n", F.col("gender"))).alias("genders"))
    only = F.when(F.size("genders") == 1, F.get("genders", F.lit(0)))
    return mentions.select("kind", "plain", "gender").distinct().join(known, ["kind", "plain"]).select(
        "kind", "plain", "gender", F.coalesce(only, "gender").alias("identity"))


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, plain, gender, value, attempt): distinct surrogates of the distinct entities (kind, plain, gender).

    A surrogate that equals another one or any original, of whatever kind, is passed over by all but the first
    entity. Each round recomputes only the entities that were passed over; ``settled`` grows by tables.
    """
    names = ["kind", "plain", "gender"]
    pending = scratch.store(entities.select(*names).distinct().withColumn("attempt", F.lit(0)), "entities")
    originals = pending.select(F.lower("plain").alias("taken"))
    settled: DataFrame | None = None
    # few bytes, but much work for each row: the first round is dealt out by number of rows, not by size
    pending = pending.repartition(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), *names)
    for _ in range(MAX_ATTEMPTS):
        value = surrogate_value(F.col("kind"), F.col("plain"), F.col("gender"), F.col("attempt"), key)
        tried = scratch.store(pending.withColumn("value", value).withColumn("taken", F.lower("value")), "tried")
        first = tried.groupBy("taken").agg(F.min(F.struct(*names)).alias("e")).select("taken", "e.*")
        for used in [originals] + ([settled.select(F.lower("value").alias("taken"))] if settled is not None else []):
            first = first.join(used, "taken", "left_anti")
        good = scratch.store(tried.join(first, ["taken", *names], "left_semi").select(*names, "value", "attempt"), "settled")
        settled = good if settled is None else settled.unionByName(good)
        pending = scratch.store(tried.join(good, names, "left_anti").select(*names, (F.col("attempt") + 1).alias("attempt")), "pending")
        if pending.isEmpty():
            return settled
    raise ValueError(f"surrogates did not become distinct in {MAX_ATTEMPTS} attempts")


def untitled(runs: DataFrame, chosen: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, place, text, count) of the runs of names in which a person known from a title stands.

    ``runs``: doc_id, text_key, place, match; ``chosen``: plain, value, one row per name of two parts or more. Runs are cut
    into stretches as long as known names are; of those that are known, the leftmost and longest are replaced.
    """
    lengths = sorted(r[0] for r in chosen.select(F.size(F.split("plain", " "))).distinct().collect())
    parts = F.split("match", " ")
    none = F.array().cast("array<struct<start:int,minus:int,plain:string>>")

    def stretches(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(parts) - n), lambda i: F.struct(
            i.alias("start"), F.lit(-n).alias("minus"), F.lower(F.array_join(F.slice(parts, i + 1, n), " ")).alias("plain")))
        return F.when(F.size(parts) >= n, each).otherwise(none)

    keys = ["doc_id", "text_key", "place", "match"]
    cut = runs.distinct().select(*keys, F.explode(F.concat(none, *[stretches(n) for n in lengths])).alias("s")).select(*keys, "s.*")
    hits = cut.join(broadcast_if_small(chosen), "plain").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "minus", "value"))).alias("hits"))
    begin = F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<start:int,minus:int,value:string>>").alias("kept"))

    def keep(acc, hit):
        return F.when(hit["start"] >= acc["free"], F.struct((hit["start"] - hit["minus"]).alias("free"), F.array_append(acc["kept"], hit).alias("kept"))).otherwise(acc)

    kept = hits.withColumn("kept", F.aggregate("hits", begin, keep, lambda acc: acc["kept"]))

    def word(text, i):
        here = F.filter("kept", lambda s: (s["start"] <= i) & (i < s["start"] - s["minus"]))
        value = F.get(here, F.lit(0))["value"]
        old = F.array_join(F.slice(parts, F.get(here, F.lit(0))["start"] + 1, -F.get(here, F.lit(0))["minus"]), " ")
        return F.when(F.size(here) == 0, text).when(F.get(here, F.lit(0))["start"] == i, F.when(old == F.upper(old), F.upper(value)).otherwise(value))

    return kept.select("doc_id", "text_key", "place", F.array_join(F.array_compact(F.transform(parts, word)), " ").alias("text"),
                       F.size("kept").cast("long").alias("count"))


def pseudonymise(docs: DataFrame, key: str = "change-me") -> DataFrame:
    """Every row of ``docs`` (doc_id, text; more columns are ignored) as doc_id, text, n_entities, kinds.

    Mentions of personal data in ``text`` are replaced by surrogates; ``kinds`` are the entity types found,
    sorted and comma-joined. Persons are found by a title; a name of two parts or more that has a title anywhere in
    ``docs`` is replaced everywhere. Null texts stay null, texts without mentions stay as they are. Equal entities
    have equal surrogates in all rows, different ones different surrogates.
    """
    scratch = Scratch(docs.sparkSession, "surrogates")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    holds = F.when(F.col("text").rlike(SIGNS), F.col("text").rlike(PATTERN)).otherwise(F.col("text").rlike(NAMES))
    holds = F.coalesce(holds, F.lit(False))
    found = scratch.store(named.where(holds).select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.split("text", PATTERN, -1).alias("pieces"),
        F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("matches")), "found")
    mentions = scratch.store(_mentions(found), "mentions")
    entities = mentions.where("kind <> 'name'")
    same_as = scratch.store(identities(entities), "identities")
    chosen = scratch.store(assign(same_as.select("kind", "plain", F.col("identity").alias("gender")), key, scratch), "chosen")
    valued = same_as.join(chosen.select("kind", "plain", F.col("gender").alias("identity"), "value"), ["kind", "plain", "identity"])
    titled = entities.join(valued.select("kind", "plain", "gender", "value"), ["kind", "plain", "gender"]).select(
        "doc_id", "text_key", "kind", "place", spelled(F.col("kind"), F.col("match"), F.col("value")).alias("text"), F.lit(1).cast("long").alias("count"))
    # a name without title means the first of several persons of that name
    people = scratch.store(chosen.where("kind = 'person' AND plain LIKE '% %'").groupBy("plain").agg(F.min(F.struct("gender", "value"))["value"].alias("value")), "people")
    bare = untitled(mentions.where("kind = 'name'").select("doc_id", "text_key", "place", "match"), people, scratch)
    replaced = titled.unionByName(bare.withColumn("kind", F.lit("person")))
    by_doc = replaced.groupBy(F.col("doc_id").alias("r_doc"), F.col("text_key").alias("r_key")).agg(
        F.collect_set(F.struct("place", "text", "count")).alias("parts"), F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"))
    by_place = F.map_from_entries(F.transform("parts", lambda p: F.struct(p["place"], p["text"])))
    joined = found.join(by_doc, found.doc_id.eqNullSafe(F.col("r_doc")) & (found.text_key == F.col("r_key")), "left").withColumn("by_place", by_place)
    # what is not replaced stays as it stood
    at = lambda i: F.coalesce(F.try_element_at("by_place", i), F.get("matches", i), F.lit(""))
    woven = F.array_join(F.transform(F.col("pieces"), lambda piece, i: F.concat(piece, at(i))), "")
    total = F.coalesce(F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["count"]), F.lit(0).cast("long"))
    changed = joined.select("doc_id", woven.alias("text"), total.alias("n_entities"), F.coalesce("kinds", F.lit("")).alias("kinds"))
    same = named.where(~holds).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"))
    return changed.unionByName(same)
