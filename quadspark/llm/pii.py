"""Replace personal data and secrets by keyed surrogates, with DataFrame functions only.

Every distinct entity gets one surrogate of its own type, format, script and, for given names, gender, wherever it
occurs, so mentions that refer to the same thing still do. Surrogates are derived from a key and re-drawn until no
two entities share one and none is itself an entity of the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch

#: Default key, a parameter; a production run passes its own secret.
KEY = "surrogate-key-1"

# Titles and given names that introduce or are personal names.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Señor|Señora"
MALE = "James|John|Robert|Michael|William|David|Thomas|Charles|Daniel|Peter|Hans|Klaus|Jürgen|Wolfgang|Pierre|Jean|Michel|Luc|José|Carlos|Miguel|Javier|Иван|Сергей|Дмитрий|Алексей"
FEMALE = "Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Sarah|Karen|Emma|Alice|Ursula|Sabine|Petra|Monika|Marie|Sophie|Camille|Claire|Carmen|Lucía|Isabel|Pilar|Анна|Мария|Ольга|Елена"

#: What announces a secret, up to where it starts but for an opening quote.
_KEY = r"(?i:token|password|passwd|secret|api[_-]?key)[\x22']?\s{0,2}[=:]\s{0,2}"
#: A secret goes on to its closing quote or to white space; without quotes, punctuation belongs to it if more of it follows.
_UNQUOTED = r"(?:[\p{L}\p{N}_+/=$%&*@#~^|\\-]|[.,;:!?(){}\[\]'](?=[.,;:!?(){}\[\]']{0,63}[\p{L}\p{N}_+/=$%&*@#~^|\\-])){8,}+"
_SECRET = rf"(?<=[=:]\s{{0,2}}[\x22']?)(?=[\x21-\x7E&&[^A-Za-z0-9\s\x22']]*+[A-Za-z0-9])(?:(?<={_KEY}\x22)(?:[^\s\x22\\]|\\\S){{8,}}+|(?<={_KEY}')(?:[^\s'\\]|\\\S){{8,}}+|(?<={_KEY})(?![(\[{{]){_UNQUOTED})"
#: A word of a family name, and the name: any number of them, after initials.
_WORD = r"\p{Lu}(?=\p{L}|['’]\p{L})[\p{L}\p{M}]*+(?:(?:-(?=\p{Lu})|['’](?=\p{Lu}|\p{L}{3}))[\p{L}\p{M}]++)*+"
_FAMILY = rf"(?:\p{{Lu}}\. ){{0,3}}+{_WORD}(?: {_WORD})*+"

#: Patterns by type, in order of precedence; every quantifier before a required character has a bound or gives nothing back.
PATTERNS = {
    "secret": rf"(?<![A-Za-z0-9])AKIA[0-9A-Z]{{16}}(?![0-9A-Za-z])|{_SECRET}",
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}+@[\p{L}\p{M}\p{N}-]{1,63}(?:\.[\p{L}\p{M}\p{N}-]{1,63}){0,6}\.[\p{L}\p{M}]{2,24}",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z+])0[0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}(?![0-9])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,4}(?![0-9])",
    "male": rf"(?<!\p{{L}})(?:{MALE})(?= \p{{Lu}}|-(?:{MALE}|{FEMALE}) \p{{Lu}})",
    "female": rf"(?<!\p{{L}})(?:{FEMALE})(?= \p{{Lu}}|-(?:{MALE}|{FEMALE}) \p{{Lu}})",
    "family": rf"(?<!\p{{L}})(?=\p{{Lu}})(?<=[\p{{L}}.] )(?<=(?<!\p{{L}})(?:(?:{TITLES})\.?|{MALE}|{FEMALE}) ){_FAMILY}",
}
#: What may match by the character before it and the one it starts with; which types are tried there, in the order above.
_STARTS = {
    "(?<![A-Za-z0-9])": {
        "[a-z]": "secret email",
        "[A-Z]": "secret email iban male female family",
        "[0-9]": "secret email ip card ssn phone",
        "[._%+(/=-]": "secret email phone",
        r"[\p{Lu}&&[^A-Z]]": "email male female family",
        r"[\p{L}\p{M}\p{N}&&[^A-Za-z0-9\p{Lu}]]": "email",
        r"[\x21-\x7E&&[^A-Za-z0-9._%+(/=-]]": "secret",
    },
    "(?<=[A-Za-z])": {"[0-9]": "ip ssn"},
    "(?<=[0-9])": {r"\p{Lu}": "male female"},
}
#: All patterns at once: the same matches as their plain alternation, but few are tried at each character.
ANY = "|".join(f"{before}(?:" + "|".join(f"(?={start})(?:{'|'.join(PATTERNS[k] for k in kinds.split())})" for start, kinds in by.items()) + ")" for before, by in _STARTS.items())

_SYLLABLES = "ba be bi bo da de di do fa fe fi ga ge go ha he ho ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe pi ra re ri ro sa se si so ta te ti to va ve vi wa we za ze zo".split()
_CYRILLIC = "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви".split()
#: Draws after which a format of fixed length takes letters for digits, so that it has more values than entities.
_STRICT = 8
_GLYPHS = {"[0-9]": "0123456789", "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
#: The same for letters beyond ASCII, later ones first: Cyrillic ones stay Cyrillic, others become Latin ones or digits.
_GLYPHS |= {r"[\p{L}\p{M}&&[^A-Za-z]]": _GLYPHS["[a-z]"], r"[\p{N}&&[^0-9]]": _GLYPHS["[0-9]"], r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"}


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _reshape(value: Column, stream: Column) -> Column:
    """Each digit or letter becomes another of its kind; what else there is stays."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        return reduce(lambda rest, kind: F.when(F.rlike(c, F.lit(kind[0])), F.substring(F.lit(kind[1]), b % len(kind[1]) + 1, F.lit(1))).otherwise(rest), _GLYPHS.items(), c)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _letters(stream: Column, n: Column, first: int = 0) -> Column:
    """As many small letters as ``n``, at most 16."""
    made = F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.substring(F.lit(_GLYPHS["[a-z]"]), _byte(stream, i + first) % 26 + 1, F.lit(1)))
    return F.array_join(F.slice(made, F.lit(1), F.least(n, F.lit(16))), "")


def _luhn(digits: Column) -> Column:
    """Check digit for a string of digits."""
    weigh = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.coalesce(d.try_cast("int"), F.lit(0)) + 1)).otherwise(F.coalesce(d.try_cast("int"), F.lit(0))))
    return (10 - F.aggregate(weigh, F.lit(0), lambda a, x: a + x) % 10) % 10


def _name(stream: Column, attempt: Column, end: dict[str, str], value: Column) -> Column:
    """A name of syllables in the script of ``value``; each further attempt adds a syllable."""

    def of(table: list[str], tail: str) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.lit(2) + attempt), lambda i: F.element_at(F.array(*[F.lit(s) for s in table]), _byte(stream, i) % len(table) + 1))
        return F.initcap(F.concat(F.array_join(made, ""), F.lit(tail)))

    return F.when(F.rlike(value, F.lit(r"\p{IsCyrillic}")), of(_CYRILLIC, end["cyrillic"])).otherwise(of(_SYLLABLES, end["latin"]))


def surrogate(kind: Column, norm: Column, attempt: Column, key: str = KEY) -> Column:
    """The keyed stand-in of one normalised entity.

    Each further attempt draws from more values, so there is always one left: names, secrets and addresses grow, and
    from attempt _STRICT on numbers have letters among their digits and IPv4 addresses become IPv6 ones.
    """
    stream = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, norm, attempt.cast("string")), 512)
    # Bound to a variable, or every character would hash the whole value again.
    return F.transform(F.array(stream), lambda bound: _made(kind, norm, attempt, bound))[0]


def _made(kind: Column, norm: Column, attempt: Column, stream: Column) -> Column:
    shaped = _reshape(norm, stream)
    length = F.length(norm)
    labels = F.split(F.substring_index(norm, "@", -1), r"\.")
    outer = F.array_join(F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), lambda x: F.concat(_reshape(x, stream), F.lit("."))), "")
    top = F.element_at(labels, -1)
    wide = F.least(attempt, F.lit(16))
    local = F.concat(F.substring(_reshape(F.substring_index(norm, "@", 1), stream), F.lit(1), 64 - wide), _letters(stream, wide))
    outer = F.when((outer == "") & (attempt > 0), F.concat(_letters(stream, wide, 16), F.lit("."))).otherwise(outer)
    email = F.concat(local, F.lit("@"), outer, F.lit("example."), F.when(top.isin("com", "net", "org"), top).otherwise(F.lit("org")))
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    ip = F.when(attempt < _STRICT, ip).otherwise(F.concat(F.lit("2001:db8"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat(F.lit(":"), F.substring(stream, i * 4 + 1, F.lit(4)))), "")))
    body = F.concat(norm.substr(F.lit(1), F.lit(1)), shaped.substr(F.lit(2), length - 2))
    valid = _luhn(norm.substr(F.lit(1), length - 1)) == norm.substr(length, F.lit(1)).try_cast("int")
    card = F.concat(body, F.when(valid, _luhn(body).cast("string")).otherwise(((_luhn(body) + 1 + _byte(stream, F.lit(63)) % 9) % 10).cast("string")))
    national = F.greatest(length - 10, F.lit(0))
    lead = (_byte(stream, F.lit(62)) % 8 + 2).cast("string")
    phone = F.concat(norm.substr(F.lit(1), national), lead, shaped.substr(national + 2, length))
    foreign = _reshape(F.regexp_replace(norm, r"[^\x00-\x7F]", "x"), stream)
    hexed = F.array_join(F.transform(F.split(norm, ""), lambda c, i: F.substring(F.lit("0123456789abcdef"), _byte(stream, i) % 16 + 1, F.lit(1))), "")
    shaped_secret = F.when(F.rlike(norm, F.lit("^[0-9a-f]+$")), hexed).otherwise(foreign)
    longer = F.concat(shaped_secret, F.substring(stream, F.lit(65), attempt))
    secret = F.when(F.rlike(norm, F.lit("^AKIA[0-9A-Z]{16}$")), F.concat(F.lit("AKIA"), shaped.substr(F.lit(5), length))).otherwise(longer)
    iban = F.concat(norm.substr(F.lit(1), F.lit(2)), shaped.substr(F.lit(3), length))
    mixed = F.array_join(F.transform(F.split(norm, ""), lambda c, i: F.substring(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"), _byte(stream, i) % 36 + 1, F.lit(1))), "")
    strict = {"card": card, "phone": phone, "iban": iban, "ssn": shaped}
    made = {"email": email, "ip": ip, "secret": secret} | {k: F.when(attempt < _STRICT, v).otherwise(mixed) for k, v in strict.items()}
    names = {"male": {"latin": "ro", "cyrillic": "н"}, "female": {"latin": "na", "cyrillic": "на"}, "family": {"latin": "ner", "cyrillic": "ов"}}
    made |= {k: _name(stream, attempt, end, norm) for k, end in names.items()}
    return reduce(lambda rest, item: F.when(kind == item[0], item[1]).otherwise(rest), made.items(), shaped)


def _kind(value: Column, before: Column) -> Column:
    """Type of a match: names are told by what stands around them, so all but those are tested on the match alone."""
    full = {k: rf"^(?:{PATTERNS[k]})$" for k in ("email", "ip", "card", "iban", "ssn", "phone")}
    lists = F.when(F.rlike(value, F.lit(rf"^(?:{MALE})$")), "male").when(F.rlike(value, F.lit(rf"^(?:{FEMALE})$")), "female")
    after_key = F.rlike(before, F.lit(rf"{_KEY}[\x22']?$")) | F.rlike(value, F.lit(r"^AKIA[0-9A-Z]{16}$"))
    kinds = F.when(after_key, "secret")
    for k, pattern in full.items():
        kinds = kinds.when(F.rlike(value, F.lit(pattern)), k)
    return kinds.otherwise(F.coalesce(lists, F.lit("family")))


_PLAIN = ("card", "iban", "ssn", "phone")


def _norm(kind: Column, value: Column) -> Column:
    """What mentions of one entity share: no separators in numbers, no capitals in addresses."""
    return F.when(kind.isin(*_PLAIN), F.regexp_replace(value, "[^0-9A-Za-z]", "")).when(kind == "email", F.lower(value)).otherwise(value)


def _render(kind: Column, value: Column, made: Column) -> Column:
    """A stand-in in the format of the mention: separators stay where they are."""
    spread = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(F.rlike(c, F.lit("[0-9A-Za-z]")), made.substr(F.length(F.regexp_replace(value.substr(F.lit(1), i + 1), "[^0-9A-Za-z]", "")), F.lit(1))).otherwise(c)), "")
    return F.when(kind.isin(*_PLAIN), spread).otherwise(made)


def _words(cut: DataFrame) -> DataFrame:
    """Make each word of a name a match of its own, as the same word may stand alone elsewhere."""
    words = F.transform("_found", lambda v: F.when(F.contains(v, F.lit(" ")) & ~F.rlike(v, F.lit("[0-9]")), F.split(v, " ")).otherwise(F.array(v)))
    between = F.flatten(F.zip_with(F.slice("_parts", F.lit(1), F.size("_found")), words, lambda part, w: F.concat(F.array(part), F.array_repeat(F.lit(" "), F.size(w) - 1))))
    return cut.withColumns({"_parts": F.concat(between, F.slice("_parts", -1, 1)), "_found": F.flatten(words)})


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """Give each distinct ``kind, norm`` its ``made``; those that clash are drawn again until all differ and none is an entity itself."""
    own = scratch.write(entities.select("kind", "norm").distinct(), "entities")
    redo, settled = own.withColumn("attempt", F.lit(0)), None
    while True:
        made = scratch.write(redo.withColumn("made", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "surrogates")
        first = made.groupBy("kind", "made").agg(F.min("norm").alias("first"), F.count("*").alias("n")).where("n > 1").select("kind", "made", "first")
        drawn = made.select("kind", "made").distinct()
        taken = own.select("kind", F.col("norm").alias("made")).join(drawn, ["kind", "made"], "left_semi")
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "made").join(drawn, ["kind", "made"], "left_semi")).distinct()
        clash = made.join(first, ["kind", "made"], "left").join(taken.withColumn("taken", F.lit(True)), ["kind", "made"], "left")
        again = (F.col("first").isNotNull() & (F.col("norm") != F.col("first"))) | F.col("taken").isNotNull()
        drawn = scratch.write(clash.select("kind", "norm", "attempt", "made", again.alias("again")), "drawn")
        done = drawn.where("not again").select("kind", "norm", "made")
        settled = done if settled is None else settled.unionByName(done)
        redo = drawn.where("again").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        if redo.isEmpty():
            return settled


#: Words of a text, apostrophes and hyphens inside them included, and what stands between words.
_TOKEN = r"[\p{L}\p{M}]++(?:[-'’](?=\p{L})[\p{L}\p{M}]++)*+|[^\p{L}\p{M}]++"
_NAMES = ("male", "female", "family")


def _spread(parts: Column, names: Column) -> Column:
    """Replace the words of a text's names wherever else they stand in it, with an 's or without."""
    owner = r"['’]s$"

    def one(t: Column) -> Column:
        bare = F.concat(F.try_element_at(names, F.regexp_replace(t, owner, "")), F.regexp_extract(t, owner, 0))
        return F.coalesce(F.when(F.rlike(t, F.lit(r"^\p{Lu}")), F.coalesce(F.try_element_at(names, t), bare)), t)

    return F.transform(parts, lambda p: F.array_join(F.transform(F.regexp_extract_all(p, F.lit(_TOKEN), F.lit(0)), one), ""))


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """Replace every detected entity in whole texts; the same rows and columns, plus long ``n_entities``.

    Names found by their title or given name are replaced wherever their words stand in the same text, unless the
    word is also there in small letters; n_entities counts what the patterns found, without these further mentions.
    Texts without entities, null and empty ones stay as they are with n_entities 0, repeated rows get the same
    surrogates, and an empty table gives no rows. A column named n_entities is replaced, others of any name stay.

    The patterns run over each text once, in the job that writes texts, matches and what stands between them;
    distinct entities get their surrogates in one table, and the parts are put together again per row.
    """
    others = [c for c in docs.columns if c not in (text_col, "n_entities")]
    quoted = [F.col(f"`{c}`") for c in others]
    kept = [f"_c{i}" for i in range(len(others))]
    marked = docs.select(*[c.alias(k) for c, k in zip(quoted, kept, strict=True)], F.col(f"`{text_col}`").alias("_text"), F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(ANY), F.lit(0)).alias("_found"))
    marked = marked.withColumns({"_row": F.monotonically_increasing_id(), "_hit": F.coalesce(F.size("_found") > 0, F.lit(False))})
    marked = marked.withColumn("_parts", F.when(F.col("_hit"), F.split("_text", ANY, -1))).withColumn("_text", F.when(~F.col("_hit"), F.col("_text")))
    marked = scratch.write(marked, "matches")
    cut = _words(marked.where("_hit").drop("_text", "_hit"))
    named = F.exists("_found", lambda v: F.rlike(v, F.lit(r"^\p{Lu}\p{L}")) & ~F.rlike(v, F.lit("[0-9]")))
    small = F.array_distinct(F.flatten(F.transform("_parts", lambda p: F.regexp_extract_all(p, F.lit(r"(?<!\p{L})\p{Ll}++"), F.lit(0)))))
    spots = cut.withColumn("_small", F.when(named, small).otherwise(F.array().cast("array<string>"))).select("_row", "_parts", "_small", F.posexplode("_found").alias("_at", "value"))
    spots = spots.select("_row", "_at", "value", F.substring(F.element_at("_parts", F.col("_at") + 1), -24, 24).alias("before"), (F.rlike("value", F.lit(r"^\p{Lu}[\p{L}\p{M}'’-]++$")) & ~F.array_contains("_small", F.lower("value"))).alias("alone"))
    spots = spots.withColumn("kind", _kind(F.col("value"), F.col("before"))).withColumn("norm", _norm(F.col("kind"), F.col("value"))).drop("before")
    spots = scratch.write(spots, "spots")
    named = spots.join(assign(spots, key), ["kind", "norm"])
    lists = named.select("_row", F.struct("_at", _render(F.col("kind"), F.col("value"), F.col("made")).alias("text")).alias("spot")).groupBy("_row").agg(F.sort_array(F.collect_list("spot")).alias("_spots"))
    names = named.where(F.col("kind").isin(*_NAMES) & F.col("alone")).groupBy("_row", "value").agg(F.min(F.struct((F.col("kind") == "family").alias("last"), "made")).alias("best"))
    names = names.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("value", "best.made"))).alias("_names"))
    put = cut.join(lists, "_row").join(names, "_row", "left").withColumn("_parts", F.when(F.col("_names").isNotNull(), _spread(F.col("_parts"), F.col("_names"))).otherwise(F.col("_parts")))
    whole = F.array_join(F.zip_with("_parts", F.col("_spots.text"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = put.select(*kept, whole.alias("_text"), F.size("_found").cast("long").alias("_n"))
    if "n_chars" in others:
        at = kept[others.index("n_chars")]
        changed = changed.withColumn(at, F.length("_text").cast(dict(docs.dtypes)["n_chars"]))
    rows = marked.where("not _hit").select(*kept, "_text", F.lit(0).cast("long").alias("_n")).unionByName(changed)
    back = dict(zip(others, kept, strict=True)) | {text_col: "_text"}
    return rows.select(*[F.col(back[c]).alias(c) for c in docs.columns if c in back], F.col("_n").alias("n_entities"))
