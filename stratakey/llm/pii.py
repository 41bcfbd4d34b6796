"""Personal data: detection, and keyed surrogates of the same type, gender, script and format.

One pattern finds e-mail addresses, telephone numbers (international, and common national forms), card numbers, IBANs, social
security numbers, IP addresses, secrets after a naming word, and names after a title. A mention's canonical form (case, spacing and
punctuation removed where they carry nothing) is its entity, so all its spellings corefer. Names are replaced word by word, and a word
has one surrogate whatever its title and place, so "Mr Ivan Petrov", "Dr Petrov" and, later in the same text, "Petrov" stay one
person; a domain has one surrogate in all its addresses. An entity's surrogate is drawn from an HMAC (SHA-512) of the canonical form:
digits for digits of the same script, letters of the same script and case for letters, valid check digits for cards and IBANs,
for names syllables of the same script with the ending of the gender that all titles of the corpus agree on, if they do.

Collision check: a candidate that equals any entity of the corpus, or a surrogate already given, or that two entities draw
at once (the least canonical form wins), is drawn again with the next attempt number until none is left. Surrogates are thus
distinct for distinct entities of a kind and never another real entity. Without the key they cannot be recomputed.

Everything is built-in expressions and joins. Texts without a digit, "@" or title are passed through unshuffled; for the
others the text moves once. Hot entities are counted before the shuffle, and their joins can be split.

Defined cases: a null text stays null, an empty one empty; rows that agree in doc_id and text are treated alike; a very long text is
searched in one task, in time linear in its length, its mentions are rows; a format with fewer values than entities grows by characters rather than let two share
a surrogate; columns named n_mentions and n_entities are replaced, others are kept whatever their names; an empty table gives no
rows. Not found: names without a title in texts that don't name them with one, and numbers of no form listed here.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, let, materialise

# Titles by gender.
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Signora", "госпожа", "г-жа", "κυρία"]
NEUTRAL = ["Dr", "Prof"]
TITLES = "|".join(sorted({*MALE, *FEMALE, *NEUTRAL, *(t.upper() for t in MALE + FEMALE + NEUTRAL)}, key=lambda t: (-len(t), t)))
# Words that stand inside names, and capitalised words that begin a sentence after one.
PARTICLES = "de|da|di|del|della|van|von|der|den|la|le|bin|al"
OPENERS = "However|The|And|But|He|She|It|In|On|At|When|Then|This|That|They|We|You|Der|Die|Das|Und|Aber|Er|Sie|Es|Les|Et|Mais|Il|Elle|El|Los|Las|Pero|Él|Ella"

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
MAIL = r"[\p{L}\p{N}_%+-]"
# a mailbox begins only where no other could have begun before, and gives nothing back, so each run of its characters is read once
EMAIL = rf"(?<!{MAIL})(?:(?<!\.)|(?<=(?<![\p{{L}}\p{{N}}._%+-])\.{{1,3}})|(?<=\.{{4}})){MAIL}++(?:\.{{1,3}}+{MAIL}++)*+@[\p{{L}}\p{{N}}-]++(?:\.[\p{{L}}\p{{N}}-]++)++"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
IP6 = r"(?<![\p{L}\p{N}:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])"
SSN = r"(?<![\p{Nd}-])\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}(?![\p{Nd}-])"
PHONE = r"\+\p{Nd}{1,3}[ .-]?(?:\(\p{Nd}{1,4}\)|\p{Nd}{1,4})(?:[ .-]?\p{Nd}{2,4}){2,4}(?!\p{Nd})"
NATIONAL = r"(?<![\d(+-])\(\d{3}\) ?\d{3}[-.]\d{4}(?![\d-])|(?<![\d.+-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d.-])|(?<![\d.,:/+-])0\d{2,4}[ /-]\d{5,8}(?![\d-])"
CARD = r"(?<![\d-])(?:\d{4}(?:[ -]?\d{4}){3}(?:[ -]?\d{3})?|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}|3[068]\d{2}[ -]?\d{6}[ -]?\d{4}|4\d{12})(?![\d-])"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
NAME_WORD = rf"(?!(?:{TITLES}|{OPENERS})(?![\p{{L}}]))\p{{Lu}}[\p{{L}}'’-]+"
PERSON = rf"(?<![\p{{L}}\p{{N}}])(?:{TITLES})\.? {NAME_WORD}(?:(?: (?:{PARTICLES})){{0,2}} {NAME_WORD}){{0,3}}"
NAMING = r"(?i:token|secret|password|passwd|api_key|apikey|access_key)"
SECRET = rf"(?<={NAMING}[ \"']{{0,2}}[=:][ \"']{{0,3}})[A-Za-z0-9_/+.-]{{12,}}"
PATTERN = f"(?:{EMAIL}|{SECRET}|{IP}|{SSN}|{PHONE}|{NATIONAL}|{CARD}|{IBAN}|{IP6}|{PERSON})"
#: True for every text in which PATTERN can match.
HINT = rf"[\p{{Nd}}@]|::|(?<![\p{{L}}\p{{N}}])(?:{TITLES})\.? \p{{Lu}}|{NAMING}[ \"']{{0,2}}[=:]"

# Syllables of surrogate names by script, then endings (male, female).
SYLLABLES = {
    "latin": ("ba be bo da de do fa fe ga ge ka ke la le lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te to va ve".split(), ("n", "a")),
    "cyrillic": ("ба бе бо да де до ка ко ла ле ло ма ме ми на не ни но ра ре ри ро са се та те то ва ве зо".split(), ("н", "а")),
    "greek": ("βα βε δα δε κα κο λα λε λι μα με μι να νε νι πα πε ρα ρε ρι ρο σα σε τα τε το φα φε".split(), ("ς", "α")),
}
# Letters by script; large scripts take a range of code points.
SCRIPT_LETTERS = {
    "Cyrillic": "абвгдежзийклмнопрстуфхцчшэюя",
    "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Han": "".join(map(chr, range(0x4E00, 0x5E00))),
    "Hangul": "".join(map(chr, range(0xAC00, 0xD7A4, 28))),
    "Hiragana": "".join(map(chr, range(0x3042, 0x3094))),
    "Katakana": "".join(map(chr, range(0x30A2, 0x30F4))),
    "Arabic": "".join(map(chr, range(0x0627, 0x063B))),
    "Hebrew": "".join(map(chr, range(0x05D0, 0x05EB))),
    "Devanagari": "".join(map(chr, range(0x0905, 0x093A))),
    "Thai": "".join(map(chr, range(0x0E01, 0x0E2F))),
}
ACCENTED = "áàâäåçéèêëíìîïñóòôöúùûüý"
#: The zeros of scripts with digits of their own: Arabic, Persian, Devanagari, Bengali, Thai, full width.
ZEROS = (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0xFF10)


def kind_of(m: Column) -> Column:
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), "ip")
        .when(m.rlike(r"^\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}$"), "ssn")
        .when(m.rlike(rf"^(?:\+.*|{NATIONAL})$"), "phone")
        .when(m.rlike(rf"^{CARD}$"), "card")
        .when(m.rlike(rf"^(?:{TITLES})\.? "), "person")
        .when(m.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?$"), "iban")
        .when(m.rlike(rf"^{IP6}$"), "ip6")
        .otherwise("secret")
    )


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def mention_parts(mentions: DataFrame) -> DataFrame:
    """mentions (.., mention) with title, part, surface, kind, canon, after and gender: a row for each entity of a mention.

    after is what stands between a part and the next; a word of kind "keep" is no entity.
    """
    m, kind = F.col("mention"), F.col("m_kind")
    named = mentions.select("*", kind_of(m).alias("m_kind"), F.regexp_extract("mention", rf"^(?:{TITLES})\.? ", 0).alias("lead"))
    whole = F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(m, r"\P{Nd}", "")).when(kind == "iban", F.regexp_replace(m, " ", "")).when(kind == "ip6", F.lower(m)).otherwise(m)
    part = lambda surface, kind, canon, after: F.struct(surface.alias("surface"), kind.alias("kind"), canon.alias("canon"), F.lit(after).alias("after"))
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    words = F.split(F.substring(m, F.length("lead") + 1, F.length(m)), " ")
    word = lambda w: part(w, F.when(w.rlike(rf"^(?:{PARTICLES})$"), "keep").otherwise(F.concat(F.lit("name-"), script_of(w))), F.lower(w), " ")
    parts = F.when(kind == "person", F.transform(words, word)).when(kind == "email", F.array(part(local, F.lit("mailbox"), F.lower(m), "@"), part(domain, F.lit("domain"), F.lower(domain), ""))).otherwise(F.array(part(m, kind, whole, "")))
    bare = F.lower(F.regexp_replace("lead", r"[. ]+$", ""))
    of = lambda titles: bare.isin([t.lower() for t in titles])
    gender = F.when(kind != "person", None).when(of(MALE), "m").when(of(FEMALE), "f")
    rows = named.select(*mentions.columns, F.when(kind == "person", F.col("lead")).otherwise("").alias("title"), gender.alias("gender"), F.posexplode(parts).alias("part", "p"))
    return rows.select(*mentions.columns, "title", "gender", "part", "p.surface", "p.kind", "p.canon", "p.after")


def digest(key: str, kind: Column, canon: Column, attempt: int) -> Column:
    """HMAC with SHA-512 of kind, attempt and canonical form, in hexadecimal."""
    block = hashlib.sha512(key.encode()).digest() if len(key.encode()) > 128 else key.encode()
    block = block.ljust(128, b"\0")
    inner, outer = (F.lit(bytearray(x ^ pad for x in block)) for pad in (0x36, 0x5C))
    message = F.encode(F.concat(kind, F.lit(f"\n{attempt}\n"), canon), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 512))), 512)


def number_at(hex_: Column, i: Column) -> Column:
    """The number from 0 to 65535 at place i of a digest, which has 32 of them and is read round and round."""
    return F.conv(F.substring(hex_, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def poured(canon: Column, hex_: Column, keep: Column) -> Column:
    """canon with all but its first `keep` characters redrawn, each in its class; other characters stay."""

    def one(c: Column, i: Column) -> Column:
        n = number_at(hex_, i)
        lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        out = F.when(i < keep, c).when(c.rlike("^[0-9]$"), letter("0123456789", n)).when(c.rlike("^[a-z]$"), letter(lower, n)).when(c.rlike("^[A-Z]$"), letter(upper, n)).when(c.rlike(r"^[\x00-\x7F]$"), c)
        for zero in ZEROS:
            digits = "".join(map(chr, range(zero, zero + 10)))
            out = out.when(c.rlike(f"^[{digits[0]}-{digits[9]}]$"), letter(digits, n))
        for script, letters in {**SCRIPT_LETTERS, "Latin": ACCENTED}.items():
            same = c.rlike(rf"^\p{{Is{script}}}$") & c.rlike(r"^\p{L}$")
            if letters.upper() != letters:
                out = out.when(same & c.rlike(r"^\p{Lu}$"), letter(letters.upper(), n))
            out = out.when(same, letter(letters, n))
        return out.when(c.rlike(r"^\p{Lu}$"), letter(upper, n)).when(c.rlike(r"^\p{L}$"), letter(lower, n)).otherwise(c)

    return F.array_join(F.transform(F.split(canon, ""), one), "")


def luhn(body: Column) -> Column:
    """Digits and their check digit."""
    digits = F.transform(F.reverse(F.split(body, "")), lambda c, i: let(c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)))
    total = F.aggregate(digits, F.lit(0), lambda a, d: a + d)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def iban(country: Column, body: Column) -> Column:
    """An account number with its check digits: the whole, country last and letters as numbers, leaves 1 by 97."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    rest = F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), step)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), body)


def name_of(hex_: Column, kind: Column, gender: Column, attempt: int) -> Column:
    out = F.lit(None).cast("string")
    for script, (syllables, (male, female)) in SYLLABLES.items():
        table = F.array(*[F.lit(s) for s in syllables])
        # more syllables with each attempt, so that names cannot run out
        stem = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2 + attempt)), lambda i: F.get(table, number_at(hex_, i) % len(syllables))), "")
        end = F.when(gender == "f", female).when(gender == "m", male).otherwise("")
        out = F.when(kind.endswith(script), F.concat(stem, end)).otherwise(out)
    return out


def candidate(key: str, kind: Column, canon: Column, gender: Column, attempt: int) -> Column:
    h = digest(key, kind, canon, attempt)
    at = lambda i: number_at(h, F.lit(i))
    octets = F.concat_ws(".", *[(at(i) % 254 + 1).cast("string") for i in range(4)])
    inner = F.when(canon.startswith("10."), F.concat(F.lit("10."), F.substring_index(octets, ".", -3))).when(canon.startswith("192.168."), F.concat(F.lit("192.168."), F.substring_index(octets, ".", -2))).otherwise(octets)
    lead = F.when(F.substring(canon, 1, 1).isin("0", "1", "7"), 1).otherwise(F.when(F.length(canon) > 10, 2).otherwise(0))
    # a domain's last part stays
    top = F.concat(F.lit("."), F.substring_index(canon, ".", -1))
    domain = F.concat(poured(F.substring(canon, F.lit(1), F.length(canon) - F.length(top)), h, F.lit(0)), top)
    hexadecimal = canon.rlike("^[0-9a-f]+$")
    secret = F.when(hexadecimal, F.substring(F.concat(h, F.sha2(h, 512), F.sha2(F.reverse(h), 512)), F.lit(1), F.length(canon))).otherwise(poured(canon, h, F.lit(0)))
    groups = F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.when(c == ":", c).otherwise(letter("123456789abcdef", number_at(h, i)))), "")
    # a format that is used up grows
    more = F.lit("") if attempt < WIDEN else poured(F.lit("0" * (1 + (attempt - WIDEN) // 4)), F.reverse(h), F.lit(0))
    return (
        F.when(kind == "mailbox", F.concat(poured(F.substring_index(canon, "@", 1), h, F.lit(0)), more))
        .when(kind == "domain", F.concat(more, domain))
        .when(kind == "ip", inner)
        .when(kind == "ip6", groups)
        .when(kind == "phone", F.concat(poured(canon, h, lead), more))
        .when(kind == "card", luhn(F.substring(poured(canon, h, F.lit(1)), F.lit(1), F.length(canon) - 1)))
        .when(kind == "ssn", F.concat(poured(canon, h, F.lit(0)), more))
        .when(kind == "iban", iban(F.substring(canon, 1, 2), poured(F.substring(canon, F.lit(5), F.length(canon)), h, F.lit(0))))
        .when(kind == "secret", F.concat(F.when(hexadecimal & (F.length(canon) > 300), poured(canon, h, F.lit(0))).otherwise(secret), more))
        .otherwise(name_of(h, kind, gender, attempt))
    )


#: The attempt from which a surrogate may be longer than its format.
WIDEN = 8


def surrogates(entities: DataFrame, key: str, attempts: int = 40) -> DataFrame:
    """(kind, canon, surrogate) of (kind, canon, gender), gender optional: one to one within a kind, and never another entity."""
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit(None).cast("string"))
    # a name's gender is what all its titles say, if they agree
    one = F.when(F.min("gender") == F.max("gender"), F.min("gender")).alias("gender")
    entities = materialise(entities.groupBy("kind", "canon").agg(one), "pii-entities")
    taken = entities.select(F.col("kind").alias("t_kind"), F.col("canon").alias("t"))
    left, done = entities, []
    for attempt in range(attempts):
        drawn = left.withColumn("surrogate", candidate(key, F.col("kind"), F.col("canon"), F.col("gender"), attempt))
        free = drawn.join(taken, (F.col("kind") == F.col("t_kind")) & (F.col("surrogate") == F.col("t")), "left_anti")
        won = materialise(free.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).select("kind", "canon", "surrogate"), "pii-surrogates")
        done.append(won)
        left = materialise(left.join(won, ["kind", "canon"], "left_anti"), "pii-open")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)
        taken = taken.unionByName(won.select(F.col("kind").alias("t_kind"), F.col("surrogate").alias("t")))
    raise ValueError("some entities found no surrogate of their format; there are too few of them")


def rendered(surface: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of a mention."""
    plain = lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}]", "")
    numbers = let(
        F.array(surface, surrogate),
        lambda p: F.concat(
            F.array_join(F.transform(F.split(F.get(p, 0), ""), lambda c, i: F.when(c.rlike(r"^[\p{L}\p{N}]$"), F.substring(F.get(p, 1), F.length(plain(F.substring(F.get(p, 0), F.lit(1), i + 1))), F.lit(1))).otherwise(c)), ""),
            F.substring(F.get(p, 1), F.length(plain(F.get(p, 0))) + 1, F.length(F.get(p, 1))),
        ),
    )
    upper = (surface == F.upper(surface)) & (surface != F.lower(surface)) & (F.length(surface) > 1)
    title = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))
    name = F.when(upper, F.upper(surrogate)).otherwise(title)
    return (
        F.when(kind == "keep", surface)
        .when(kind.isin("phone", "card", "ssn", "iban"), numbers)
        .when(kind.isin("mailbox", "domain"), F.when(upper, F.upper(surrogate)).when(F.substring(surface, 1, 1) != F.lower(F.substring(surface, 1, 1)), title).otherwise(surrogate))
        .when(kind == "ip6", F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .when(kind.isin("ip", "secret"), surrogate)
        .otherwise(name)
    )


def renamed(text: Column, names: Column) -> Column:
    """text with each (surface, new) of names replaced where it stands as a whole word, also in capitals.

    The order doesn't matter: no surrogate is a name of the corpus.
    """

    def one(t: Column, n: Column) -> Column:
        word = lambda w: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), w, F.lit(r"(?![\p{L}\p{N}])"))
        return F.regexp_replace(F.regexp_replace(t, word(n["surface"]), n["new"]), word(F.upper(n["surface"])), F.upper(n["new"]))

    return F.aggregate(names, text, one)


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """docs with text replaced, and the counts n_mentions and n_entities of each row."""
    columns = [c for c in docs.columns if c not in ("n_mentions", "n_entities")]
    docs = docs.select(*columns)
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    row = [F.col("doc_id").alias("__r_id"), F.xxhash64("text").alias("__r_hash")]
    mentions = docs.where(hinted).select(*row, F.posexplode(found).alias("pos", "mention")).distinct()
    parts = materialise(mention_parts(mentions).drop("mention"), "pii-parts")
    given = surrogates(parts.where("kind <> 'keep'").select("kind", "canon", "gender"), key)
    named = parts.join(given, ["kind", "canon"], "left").withColumn("new", rendered(F.col("surface"), F.col("kind"), F.col("surrogate")))
    is_name = F.col("kind").startswith("name-") & (F.length("canon") > 2)
    inner = F.array_sort(F.collect_list(F.struct("part", "new", "after")))
    joined = F.array_join(F.transform(inner, lambda p: F.concat(p["new"], F.when(p["part"] < F.size(inner) - 1, p["after"]).otherwise(""))), "")
    whole = named.groupBy("__r_id", "__r_hash", "pos").agg(
        F.concat(F.first("title"), joined).alias("new"),
        F.collect_list(F.when(F.col("kind") != "keep", F.struct("kind", "canon"))).alias("who"),
        F.collect_list(F.when(is_name, F.struct("surface", "new"))).alias("names"),
    )
    rows = whole.groupBy("__r_id", "__r_hash").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda s: s["new"]).alias("__news"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("__names"),
        F.size(F.array_distinct(F.flatten(F.collect_list("who")))).cast("long").alias("__entities"),
    )
    placed = docs.where(hinted).join(rows, docs["doc_id"].eqNullSafe(F.col("__r_id")) & (F.xxhash64("text") == F.col("__r_hash")), "left")
    gaps = F.split("text", PATTERN, -1)
    replaced = F.array_join(F.zip_with(gaps, "__news", lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    text = F.when(F.col("__news").isNull(), F.col("text")).otherwise(F.when(F.size("__names") > 0, renamed(replaced, F.col("__names"))).otherwise(replaced))
    zero = F.lit(0).cast("long")
    changed = placed.withColumns({"text": text, "n_mentions": F.greatest(zero, F.coalesce(F.size("__news").cast("long"), zero)), "n_entities": F.coalesce("__entities", zero)})
    return docs.where(~hinted).select("*", zero.alias("n_mentions"), zero.alias("n_entities")).unionByName(changed.select(*columns, "n_mentions", "n_entities"))


#: The session setting that holds the key. Whoever knows it can tell whether a guessed entity has a given surrogate.
KEY = "spark.stratakey.pii.key"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir).select("doc_id", "text"), spark.conf.get(KEY, "a key for tests only"))
