"""PII: detected entities receive keyed surrogates of the same kind, in DataFrame operations only.

Detection is one pattern over the whole text: email addresses, phone, card and account numbers, IP addresses,
access tokens, and person names (after a form of address, or a known given name before a family name).

A surrogate is derived from a keyed hash of the entity's normal form, so every mention of an entity, in any
document and format, gets the same one: digits are poured into the mention's own format, letters keep
their script and case, a card number keeps whether its check digit holds, given names keep their gender, and
the parts of a name are entities of their own, so that a family name alone still refers to the same person.
Surrogates are checked against each other and against all detected entities: what collides is derived anew
with the next attempt, on a wider space, until all are distinct. A name that a mention introduced is also replaced
where it stands alone in the same text; this looks at the text between the mentions, in one pass and before any
surrogate is put in, so that no surrogate is taken for a name.

Names are found after a form of address in ``TITLES`` or after a given name in ``GIVEN`` (a fixed list); other names
("Emma Miller" without a title) and names in capitals are not found. Phone numbers are found in the forms of
``PATTERNS``: an international prefix, an area code in brackets, three groups, or groups of two.

Only the mentions, keyed by a digest of the text, are joined and grouped; texts without a mention pass
unchanged, and copies of a text are worked on once.

Defined results: a null or empty text stays as it is; repeated rows get equal texts; other columns pass through,
whatever their names; very long texts are read whole, in time linear in their mentions (times the text's own names,
where it has any); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from interlog.llm.shared import unused
from interlog.session import cut_lineage

# Forms of address and frequent given names by gender and script.
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "г-жа"],
          "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "г-н"], "u": ["Dr", "Prof"]}
GIVEN = {
    ("f", "latin"): ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Ursula", "Monika",
                     "Françoise", "Isabelle", "Nathalie", "Carmen", "Lucía", "Pilar"],
    ("m", "latin"): ["John", "James", "Robert", "Michael", "William", "David", "Richard", "Hans", "Klaus", "Jürgen", "Wolfgang",
                     "Pierre", "Jacques", "Michel", "Carlos", "Miguel", "Javier"],
    ("u", "latin"): ["Alex", "Robin", "Kim", "Sascha", "Dominique", "Jordan", "Taylor", "Morgan"],
    ("f", "cyrillic"): ["Ольга", "Наталья", "Татьяна", "Елена", "Ирина", "Светлана"],
    ("m", "cyrillic"): ["Иван", "Сергей", "Дмитрий", "Алексей", "Николай", "Михаил"],
    ("u", "cyrillic"): ["Саша", "Женя", "Валя"],
}
FAMILY = {
    "latin": ["Miller", "Weaver", "Hoffmann", "Schreiber", "Laurent", "Moreau", "Herrera", "Navarro", "Sutton", "Fletcher",
              "Brandt", "Keller", "Garnier", "Fontaine", "Ortega", "Vidal"],
    "cyrillic": ["Кузнецов", "Попов", "Соколов", "Лебедев", "Козлов", "Новиков"],
}
SYLLABLES = {"latin": ["ba", "de", "ri", "no", "la", "mi", "sto", "ken", "var", "lin", "do", "ra", "tel", "mor", "sa", "vi"],
             "cyrillic": ["ба", "де", "ри", "но", "ла", "ми", "сто", "кен", "вар", "лин", "до", "ра", "тел", "мор", "са", "ви"]}
ENDINGS = {("f", "latin"): "a", ("f", "cyrillic"): "а", ("m", "latin"): "us", ("m", "cyrillic"): "ор"}
LETTERS = {"cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "wide": "áàâäéèêëíîïóôöúùûüñç"}

_B, _E = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# a genitive's 's and a closing quote or hyphen are no part of the name
_NAME = r"\p{Lu}(?=[\p{L}'’\-])\p{L}*+(?:(?:-|['’](?!s(?!\p{L})))\p{L}++){0,4}+"
_TITLE = "(?:" + "|".join(t for g in TITLES.values() for t in g) + ")"
_NO_TITLE = rf"(?!{_TITLE}{_E})"
_KNOWN = "(?:" + "|".join(n for g in GIVEN.values() for n in g) + ")"
#: kind -> pattern, in the order in which they are tried
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+",
    "token": _B + r"(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|(?=[a-f]*[0-9])[0-9a-f]{32,}+|(?=[A-F]*[0-9])[0-9A-F]{32,}+)" + _E,
    "account": _B + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _E,
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}]|\.[0-9])",
    "ip6": r"(?<![\p{L}\p{N}:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\p{L}\p{N}:])",
    "card": _B + r"(?:[0-9][ \-]?){12,18}[0-9]" + _E,
    "phone": _B + r"(?:\+[0-9]{8,15}|(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}"
             r"|(?:0[0-9]|\+[0-9]{1,3}[ .\-]?[0-9])(?:[ .\-][0-9]{2}){4}|\+[0-9]{1,3}[ .\-][0-9]{3}(?:[ .\-][0-9]{2}){3}"
             r"|\+[0-9]{1,3}[ .\-][0-9]{2,4}[ .\-][0-9]{5,8}|0[0-9]{2,4}/[0-9]{5,8})" + _E,
    "person": _B + rf"(?:{_TITLE}\.? {_NAME}(?: {_NO_TITLE}{_NAME})?|{_KNOWN} {_NO_TITLE}{_NAME})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: words without which no name is detected
NAME_WORDS = sorted({w for names in [*TITLES.values(), *GIVEN.values()] for n in names for w in n.split("-")[:1]})
DIGITS_ONLY = ("ssn", "card", "phone")


def kind_of(found: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, p in reversed(PATTERNS.items()):
        kind = F.when(found.rlike(f"^(?:{p})$"), name).otherwise(kind)
    return kind


def has_mention(text: Column) -> Column:
    """Whether the pattern finds anything; texts without digits, at signs, token marks and name words are told quickly."""
    words = F.split(text, r"[^\p{L}\p{N}]+", -1)
    quick = text.rlike("[0-9@]|AKIA|ASIA|gh[pousr]_|:[a-fA-F]{1,4}:") | F.arrays_overlap(words, F.array(*map(F.lit, NAME_WORDS)))
    return F.coalesce(quick & text.rlike(PATTERN), F.lit(False))


def script_of(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def parts_of(found: Column, kind: Column) -> Column:
    """The mention's entities: (type, normal form, text as found); what no entity covers has no type."""
    one = lambda t, norm, raw: F.struct(t.alias("type"), norm.alias("norm"), raw.alias("raw"))
    none = F.lit(None).cast("string")
    title = F.regexp_extract(found, rf"^{_TITLE}\.? ", 0)
    names = F.split(F.substring(found, F.length(title) + 1, F.length(found)), " ")
    given = F.when(F.size(names) > 1, names[0])
    bare = F.regexp_replace(F.trim(title), r"\.$", "")
    gender = F.lit("u")
    for g in "fm":
        gender = F.when(bare.isin(TITLES[g]), g).otherwise(gender)
    for (g, _), known in GIVEN.items():
        gender = F.when(given.isin(known), g).otherwise(gender)
    family = F.element_at(names, -1)
    person = F.concat(
        F.when(title != "", F.array(one(none, none, title))).otherwise(F.array().cast("array<struct<type:string,norm:string,raw:string>>")),
        F.when(given.isNotNull(), F.array(
            one(F.concat_ws(":", F.lit("given"), gender, script_of(given)), F.lower(given), given), one(none, none, F.lit(" "))))
        .otherwise(F.array().cast("array<struct<type:string,norm:string,raw:string>>")),
        F.array(one(F.concat(F.lit("family:"), script_of(family)), F.lower(family), family)))
    norm = (F.when(kind == "email", F.lower(found)).when(kind.isin(*DIGITS_ONLY), F.regexp_replace(found, "[^0-9]", ""))
            .when(kind == "account", F.regexp_replace(found, " ", "")).otherwise(found))
    return F.when(kind == "person", person).otherwise(F.array(one(kind, norm, found)))


def _choice(byte: Column, options) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (byte % len(options) + 1).cast("int"))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, (F.pmod(i, F.lit(128)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _masked(text: Column, stream: Column, hex_only: bool = False) -> Column:
    """Every letter and digit replaced by another of its class; other characters stay."""
    lower = "abcdef" if hex_only else "abcdefghijklmnopqrstuvwxyz"

    def one(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        new = F.when(c.rlike("[0-9]"), _choice(b, "0123456789")).when(c.rlike("[a-z]"), _choice(b, lower)).when(
            c.rlike("[A-Z]"), _choice(b, lower.upper()))
        if not hex_only:
            new = (new.when(c.rlike(r"\p{IsCyrillic}"), _choice(b, LETTERS["cyrillic"])).when(c.rlike(r"\p{IsGreek}"), _choice(b, LETTERS["greek"]))
                   .when(c.rlike(r"\p{L}"), _choice(b, LETTERS["wide"])))
        return new.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn(digits: Column) -> Column:
    """Sum of the check digit rule, 0 modulo 10 where it holds."""
    def weighed(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), weighed), F.lit(0), lambda a, x: a + x)


def derived(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normal form; later attempts of names and addresses draw from wider spaces."""
    text = F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"))
    stream = F.concat(*(F.sha2(F.concat(text, F.lit(f"\x1f{k}")), 256) for k in range(4)))
    b = lambda i: _byte(stream, F.lit(i))
    more = F.when(attempt >= 4, F.substring(stream, F.lit(200), F.least(attempt, F.lit(40)))).otherwise("")
    domain = F.substring_index(norm, "@", -1)
    labels = F.split(domain, r"\.")
    sub = F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), ".")
    top = F.element_at(labels, -1)
    email = F.concat(_masked(F.substring_index(norm, "@", 1), stream), more, F.lit("@"),
                     F.when(sub != "", F.concat(_masked(sub, F.reverse(stream)), F.lit("."))).otherwise(""),
                     F.lit("example."), F.when(top.isin("com", "net", "org"), top).otherwise("com"))
    private = F.regexp_extract(norm, r"^(10\.|192\.168\.|127\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)", 1)
    narrow = private.startswith("192.168.") | private.startswith("172.")
    octets = F.concat_ws(".", b(0) % 223 + 1, b(1), b(2), b(3) % 254 + 1)
    ip = F.when(narrow & (attempt >= 16), F.concat_ws(".", F.lit("10"), b(1), b(2), b(3) % 254 + 1)).when(
        narrow & (attempt >= 8), F.concat_ws(".", F.lit("172"), b(0) % 16 + 16, b(1), b(3) % 254 + 1)).when(
        narrow, F.concat(private, b(1).cast("string"), F.lit("."), (b(2) % 254 + 1).cast("string"))).when(
        private != "", F.concat(private, F.concat_ws(".", b(1), b(2), b(3) % 254 + 1))).otherwise(octets)
    kept = F.when(kind == "phone", F.greatest(F.length(norm) - 10, F.lit(0))).when(kind == "card", 1).otherwise(0)
    digits = F.concat(F.substring(norm, F.lit(1), kept), F.substring(_masked(norm, stream), kept + 1, F.length(norm)))
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    check = F.concat(body, F.pmod(-luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
    last = F.substring(check, F.length(check), F.lit(1)).cast("int")
    broken = F.concat(body, F.when(luhn(digits) % 10 == 0, ((last + 1) % 10).cast("string")).otherwise(F.substring(digits, F.length(digits), F.lit(1))))
    card = F.when(luhn(norm) % 10 == 0, check).otherwise(broken)
    account = F.concat(F.substring(norm, 1, 2), F.substring(_masked(norm, stream), F.lit(3), F.length(norm)))
    out = (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind.isin("phone", "ssn"), digits)
           .when(kind == "account", account).when(kind.isin("token", "ip6"), F.when(
               norm.rlike("^(?:[0-9a-f:]+|[0-9A-F:]+)$"), _masked(norm, stream, True))
               .otherwise(F.concat(F.substring(norm, 1, 4), F.substring(_masked(norm, stream), F.lit(5), F.length(norm))))))

    def made(script: str, ending: str) -> Column:
        size = F.least(F.lit(2) + attempt, F.lit(40))
        return F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(4), F.lit(3) + size), lambda i: _choice(_byte(stream, i), SYLLABLES[script])), ""),
                                  F.lit(ending)))

    for (gender, script), pool in GIVEN.items():
        name = F.when(attempt == 0, _choice(b(0), pool)).otherwise(
            made(script, ENDINGS.get((gender, script), "")))
        out = out.when(kind == f"given:{gender}:{script}", name)
    for script, pool in FAMILY.items():
        name = F.when(attempt == 0, _choice(b(0), pool)).otherwise(
            made(script, ""))
        out = out.when(kind == f"family:{script}", name)
    return out


def surrogates(entities: DataFrame, key: str, attempts: int = 64) -> DataFrame:
    """(type, norm, surrogate): distinct surrogates for distinct entities, none of them a detected entity.

    Of the entities that meet on a surrogate the smallest keeps it; the others, and those that meet a detected
    entity or an earlier surrogate, try again. What an attempt gives is written, so the next reads tables.
    """
    space = F.when(F.col("type").rlike("^(?:given|family)"), "name").otherwise(F.col("type"))
    entities = cut_lineage(entities.select("type", "norm", space.alias("space")).distinct(), "entities")
    real = entities.select("space", F.lower("norm").alias("form"))
    spark = entities.sparkSession
    taken = spark.createDataFrame([], "space string, form string, type string, norm string, surrogate string")
    rest = entities
    for k in range(attempts):
        tried = rest.withColumn("surrogate", derived(F.col("type"), F.col("norm"), F.lit(k), key)).withColumn("form", F.lower("surrogate"))
        free = tried.join(real, ["space", "form"], "left_anti").join(taken, ["space", "form"], "left_anti")
        best = free.groupBy("space", "form").agg(F.min(F.struct("norm", "type", "surrogate")).alias("best"))
        won = cut_lineage(best.select("space", "form", "best.type", "best.norm", "best.surrogate"), "surrogates")
        taken = taken.union(won)
        rest = cut_lineage(rest.join(won, ["type", "norm"], "left_anti"), "entities_left")
        if rest.isEmpty():
            return taken.select("type", "norm", "surrogate")
    raise RuntimeError("no distinct surrogates left for some entities")


def rendered(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format."""
    def poured(keep: str) -> Column:
        def one(c: Column, i: Column) -> Column:
            at = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), f"[^{keep}]", ""))
            return F.when(c.rlike(f"[{keep}]"), F.substring(surrogate, at, F.lit(1))).otherwise(c)
        return F.array_join(F.transform(F.split(raw, ""), one), "")

    shouted = (F.upper(raw) == raw) & (F.length(raw) > 1)
    return (F.when(kind.isNull(), raw).when(kind.isin(*DIGITS_ONLY), poured("0-9")).when(kind == "account", poured("0-9A-Z"))
            .when(kind.rlike("^(?:given|family)") & shouted, F.upper(surrogate)).otherwise(surrogate))


def mentions(docs: DataFrame, text_col: str) -> DataFrame:
    """(digest, pos, part, type, norm, raw) of every distinct text with a mention."""
    found = docs.where(has_mention(F.col(text_col))).select(
        F.md5(text_col).alias("digest"), F.regexp_extract_all(F.col(text_col), F.lit(PATTERN), F.lit(0)).alias("found"))
    each = found.groupBy("digest").agg(F.first("found").alias("found")).select("digest", F.posexplode("found").alias("pos", "found"))
    return each.select("digest", "pos", F.posexplode(parts_of(F.col("found"), kind_of(F.col("found")))).alias("part", "p")).select(
        "digest", "pos", "part", "p.*")


def _names_replaced(text: Column, names: Column) -> Column:
    """``text`` with each of ``names`` (longest first; name and new), where it stands as a word, replaced: one pass."""
    pattern = F.concat(F.lit(_B + "(?:"), F.array_join(F.transform(names, lambda p: p["name"]), "|"), F.lit(")" + _E))
    new = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)),
                      lambda found: F.filter(names, lambda p: p["name"] == found)[0]["new"])
    return F.array_join(F.zip_with(F.split(text, pattern, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text; ``count_col`` names a column for the number of mentions replaced."""
    parts = cut_lineage(mentions(docs, text_col), "mentions")
    known = surrogates(parts.where("type is not null").select("type", "norm"), key)
    named = parts.join(known, ["type", "norm"], "left")
    put = named.select("digest", "pos", "part", rendered(F.col("type"), F.col("raw"), F.col("surrogate")).alias("new"),
                       F.when(F.col("type").rlike("^(?:given|family)"), F.col("raw")).alias("name"))
    # a text's mentions are gathered beside the text they come from, which is one row as well
    each = put.groupBy("digest", "pos").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "new"))), lambda p: p["new"]), "").alias("new"),
        F.collect_list(F.when(F.col("name").isNotNull(), F.struct(-F.length("name"), "name", "new"))).alias("names"))
    digest, news, alone, gaps, count = (unused(docs.columns, c) for c in ("_digest", "_news", "_alone", "_gaps", "_n"))
    lists = each.groupBy("digest").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda p: p["new"]).alias(news),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias(alone)).withColumnRenamed("digest", digest)
    hit = has_mention(docs[text_col])
    names = docs.columns
    plain = docs.where(~hit).select(*names, F.lit(0).cast("long").alias(count))
    others = [docs[c] for c in names if c != text_col]
    with_gaps = docs.where(hit).select(*others, F.split(docs[text_col], PATTERN, -1).alias(gaps), F.md5(docs[text_col]).alias(digest))
    rest = F.when(F.size(alone) > 0, F.transform(gaps, lambda g: _names_replaced(g, F.col(alone)))).otherwise(F.col(gaps))
    filled = F.array_join(F.zip_with(rest, news, lambda g, new: F.concat(g, F.coalesce(new, F.lit("")))), "")
    full = with_gaps.join(lists, digest).withColumn(text_col, filled).withColumn(count, F.size(gaps).cast("long") - 1)
    out = plain.union(full.select(*names, count))
    return out.withColumnRenamed(count, count_col) if count_col else out.drop(count)
