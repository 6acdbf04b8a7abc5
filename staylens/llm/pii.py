"""Surrogates for personal data (DataFrame functions only).

Detected: e-mail addresses, IPv4 addresses, IBANs, social security numbers, phone
numbers, payment card numbers (13 to 19 digits) and persons named with a title: all the
capitalised parts that follow it, and every other mention of one of these parts (as it
stands, in capitals or with one capital) in the same document. Each is replaced by a keyed surrogate of its own type and format:

* digits go through a keyed Feistel permutation of the digit strings of that length,
  so different numbers stay different, the same number written in another way gets
  the same digits, and separators stay; card numbers keep their first digit and
  whether their check digit holds; phone numbers keep the first digit of the country code;
  an IPv4 address is permuted as a 32-bit number;
* e-mail addresses get a pronounceable local part and a reserved domain, each hashed
  from its own half, so addresses of one domain stay together;
* names keep their title; each name becomes syllables in the same script, with an
  ending that fits the title's gender (a mention: that of the first title with the name;
  Dr. and Prof. alone: as Mr). The same name gives the same syllables. Particles stay.

Hashed names are not distinct by construction. ``surrogate_width`` looks for two
different originals with one surrogate, or a surrogate that is some other original,
over the whole corpus (names also part by part), and lengthens all hashed names until there is none.

Cases: null texts stay null; texts without personal data stay as they are; repeated
rows are treated alike; an empty table gives no rows; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staylens.llm.common import stored

# Fixed patterns (Java syntax). Runs are possessive and start at their left end: no backtracking in long texts.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
         r"|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d|[ .-]\d)"
         r"|(?:\(0\d{1,4}\) ?|(?<![\d.-])0\d{1,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d|[ .-]\d)")
CARD = r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\d|-\d)"
MALE = r"Mr|Herr|Señor|Sr|Monsieur|Г-н|Κύριος"
FEMALE = r"Mrs|Ms|Miss|Frau|Señora|Sra|Mme|Madame|Г-жа|Κυρία"
NEUTRAL = r"Dr|Prof"
TITLE = rf"(?:{MALE}|{FEMALE}|{NEUTRAL})"
TITLES = rf"{TITLE}\.?(?: {TITLE}\.?(?= ))*+"
PARTICLE = r"(?:(?:van|von|vom|der|den|de|del|della|di|da|dos|das|du|la|le|el|al|bin|ibn|zu|ter|ten) ){0,3}+"
# A capitalised part: initials, or letters with inner capitals, apostrophes (not a genitive 's) and hyphens.
TAIL = r"[\p{L}\p{M}]*+"
PART = rf"(?!{TITLE}(?![\p{{L}}\p{{M}}]))\p{{Lu}}(?:\.(?:\p{{Lu}}\.)*+|{TAIL}(?:['’](?!S(?!\p{{L}}))\p{{Lu}}{TAIL}|[-‐]\p{{Lu}}{TAIL})*+)"
PERSON = rf"(?<![\p{{L}}\p{{N}}]){TITLES} {PARTICLE}{PART}(?: {PARTICLE}{PART})*+"
ANY = "|".join((EMAIL, IPV4, IBAN, SSN, PHONE, CARD, PERSON))
# A text without any of these holds none of the above.
NAME_HINT = rf"{TITLE}\.? \p{{L}}"
HINT = rf"@|\d\D?\d|{NAME_HINT}"
# Sixteen syllables per script: one per hexadecimal digit of a hash.
SYLLABLES = {
    "latin": "ba de fi go lu ma ne pi ro su ta ve wi zo ka li".split(),
    "cyrillic": "ба де фи го лу ма не пи ро су та ве ви зо ка ли".split(),
    "greek": "βα δε φι γο λυ μα νε πι ρο συ τα βε κι ζο κα λι".split(),
}
ENDINGS = {"latin": ("n", "a"), "cyrillic": ("н", "а"), "greek": ("ς", "α")}
ROUNDS = 6


def _hash(key: str, *parts) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts), 256)


def _number(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def _feistel(key: str, kind: str, left: Column, right: Column, wide_left: Column, wide_right: Column, salt: Column) -> Column:
    """Struct (l, r): the pair of numbers below wide_left and wide_right, permuted."""
    def step(acc, i):
        h_left = _number(_hash(key, F.lit(kind), salt, i.cast("string"), acc["r"].cast("string")))
        h_right = _number(_hash(key, F.lit(kind), salt, i.cast("string"), acc["l"].cast("string")))
        odd = i % 2 == 1
        return F.struct(F.when(odd, F.pmod(acc["l"] + F.pmod(h_left, wide_left), wide_left)).otherwise(acc["l"]).alias("l"),
                        F.when(odd, acc["r"]).otherwise(F.pmod(acc["r"] + F.pmod(h_right, wide_right), wide_right)).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.alias("l"), right.alias("r")), step)


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A keyed permutation of the digit strings of one length (2 to 18 digits)."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    b = n - a
    ten = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    got = _feistel(key, kind, F.substr(digits, F.lit(1), a).cast("long"), F.substr(digits, a + 1).cast("long"),
                   ten(a), ten(b), n.cast("string"))
    # the pair is built once and read twice
    return F.element_at(F.transform(F.array(got), lambda p: F.concat(
        F.lpad(p["l"].cast("string"), a, "0"), F.lpad(p["r"].cast("string"), b, "0"))), 1)


def luhn(digits: Column) -> Column:
    """Check digit that the digits before it call for."""
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(
        i % 2 == 0, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1))
        .otherwise(d.cast("int")))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda s, x: s + x), F.lit(10))


def refill(original: Column, digits: Column) -> Column:
    """``original`` with its digits replaced one by one."""
    chars = F.split(original, "")
    step = lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(
        F.concat(acc["s"], F.substr(digits, acc["i"], F.lit(1))).alias("s"), (acc["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(acc["s"], c).alias("s"), acc["i"].alias("i")))
    return F.aggregate(chars, F.struct(F.lit("").alias("s"), F.lit(1).alias("i")), step, lambda acc: acc["s"])


def _syllables(h: Column, n: int, script: str) -> Column:
    table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
    digits = F.split(F.substring(h, 1, n), "")
    return F.array_join(F.transform(digits, lambda d: F.element_at(table, F.conv(d, 16, 10).cast("int") + 1)), "")


def _name(key: str, name: Column, female: Column, width: int) -> Column:
    h = _hash(key, F.lit("name"), F.lower(name))

    def written(script):
        return F.initcap(F.concat(_syllables(h, width, script),
                                  F.when(female, F.lit(ENDINGS[script][1])).otherwise(F.lit(ENDINGS[script][0]))))

    new = (F.when(name.rlike(r"\p{IsCyrillic}"), written("cyrillic")).when(name.rlike(r"\p{IsGreek}"), written("greek"))
           .otherwise(written("latin")))
    return F.when(name.rlike(r"^\p{Lu}[^\p{Ll}.]+$"), F.upper(new)).otherwise(new)


def _let(value: Column, f) -> Column:
    """f(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _title(x: Column) -> Column:
    return F.regexp_extract(x, rf"^{TITLES}(?= )", 0)


def _female(title: Column) -> Column:
    return title.rlike(rf"(?:^| )(?:{FEMALE})\.?(?: |$)")


def _parts(x: Column) -> Column:
    """The parts of a person's name, particles too, without the title."""
    return F.split(F.trim(F.substr(x, F.length(_title(x)) + 1)), " ")


def known_names(t: Column) -> Column:
    """Array of (part, female) of the persons that a text names with a title, initials left out."""
    persons = F.filter(F.regexp_extract_all(t, F.lit(ANY), 0), lambda x: _title(x) != "")
    named = F.flatten(F.transform(persons, lambda x: F.transform(
        F.filter(_parts(x), lambda n: n.rlike(r"^\p{Lu}[^.]+$")), lambda n: F.struct(n.alias("n"), _female(_title(x)).alias("f")))))
    return F.when(t.rlike(NAME_HINT), named).otherwise(F.array().cast("array<struct<n:string,f:boolean>>"))


def pattern_of(known: Column) -> Column:
    """ANY, and whole-word mentions of the known names."""
    forms = F.array_distinct(F.flatten(F.transform(known, lambda e: F.array(e["n"], F.upper(e["n"]), F.initcap(F.lower(e["n"]))))))
    longest = F.transform(F.sort_array(F.transform(forms, lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n")))), lambda e: e["n"])
    word = F.concat(F.lit("(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{M}])"))
    return F.when(F.size(known) == 0, F.lit(ANY)).otherwise(_let(word, lambda w: F.concat(
        F.lit(ANY + r"|(?<![\p{L}\p{M}\p{N}])"), w, F.lit("(?: "), w, F.lit(")*+"))))


def kind_of(x: Column) -> Column:
    out = F.when(x.rlike("@"), "email")
    for kind, pattern in (("ip", IPV4), ("iban", IBAN), ("ssn", SSN), ("phone", PHONE), ("card", CARD)):
        out = out.when(x.rlike(f"^(?:{pattern})$"), kind)
    return out.otherwise("person")


def canonical(x: Column, kind: Column) -> Column:
    """What makes two spellings one entity."""
    return (F.when(kind == "email", F.lower(x)).when(kind.isin("phone", "card", "ssn"), F.regexp_replace(x, "[^0-9]", ""))
            .when(kind == "iban", F.regexp_replace(x, " ", ""))
            .when(kind == "person", F.lower(x)).otherwise(x))


def surrogate(x: Column, kind: Column, key: str, width: int, known: Column | None = None) -> Column:
    """The replacement of one detected string; ``known`` are the names of its document."""
    digits = F.regexp_replace(x, "[^0-9]", "")
    local, domain = F.lower(F.substring_index(x, "@", 1)), F.lower(F.substring_index(x, "@", -1))
    email = F.concat(_syllables(_hash(key, F.lit("email"), local, domain), width, "latin"), F.lit("@"),
                     _syllables(_hash(key, F.lit("domain"), domain), width, "latin"), F.lit(".example.org"))
    oct_ = F.transform(F.split(x, r"\."), lambda o: o.cast("long"))
    wide = F.lit(65536).cast("long")
    moved = _feistel(key, "ip", F.get(oct_, F.lit(0)) * 256 + F.get(oct_, F.lit(1)),
                     F.get(oct_, F.lit(2)) * 256 + F.get(oct_, F.lit(3)), wide, wide, F.lit(""))
    ip = F.element_at(F.transform(F.array(moved), lambda p: F.concat_ws(
        ".", *[F.floor(p[h] / 256).cast("string") if hi else (p[h] % 256).cast("string") for h in "lr" for hi in (True, False)])), 1)
    # a country code's first digit, an area code of a local number: all but the first digit moves
    phone = refill(x, F.concat(F.substring(digits, 1, 1), permute_digits(key, "phone", F.substr(digits, F.lit(2)))))
    middle = F.substr(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(F.substring(digits, 1, 1), permute_digits(key, "card", middle))
    off = F.pmod(F.substring(digits, -1, 1).cast("int") - luhn(F.substr(digits, F.lit(1), F.length(digits) - 1)), F.lit(10))
    card = refill(x, F.element_at(F.transform(F.array(body), lambda b: F.concat(
        b, F.pmod(luhn(b) + off, F.lit(10)).cast("string"))), 1))
    ssn = refill(x, permute_digits(key, "ssn", digits))
    bare = F.regexp_replace(x, " ", "")
    iban_h = F.conv(F.substring(_hash(key, F.lit("iban"), bare), 1, 15), 16, 10)
    iban = refill(x, F.rpad(F.concat(iban_h, F.conv(F.substring(_hash(key, F.lit("iban2"), bare), 1, 15), 16, 10)), 40, "7"))
    title = _title(x)

    def female(n):
        if known is None:
            return _female(title)
        first = F.get(F.filter(known, lambda e: F.lower(e["n"]) == F.lower(n)), F.lit(0))["f"]
        return F.when(title != "", _female(title)).otherwise(F.coalesce(first, F.lit(False)))

    names = F.transform(_parts(x), lambda n: F.when(n.rlike(r"^\p{Lu}"), _name(key, n, female(n), width)).otherwise(n))
    person = F.concat(title, F.when(title != "", F.lit(" ")).otherwise(F.lit("")), F.array_join(names, " "))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "iban", iban).when(kind == "ssn", ssn)
            .when(kind == "phone", phone).when(kind == "card", card).otherwise(person))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct detected strings ``x``."""
    t = F.col(text)
    return docs.where(t.rlike(HINT)).select(F.explode(F.regexp_extract_all(t, F.lit(ANY), 0)).alias("x")).distinct()


def surrogate_pairs(docs: DataFrame, key: str, width: int, text: str = "text") -> DataFrame:
    """Per entity its kind and keyed hashes of original and surrogate (no personal data is written)."""
    x, k = F.col("x"), F.col("k")
    named = entities(docs, text).withColumn("k", kind_of(x)).withColumn("new", surrogate(x, k, key, width))
    whole = F.struct(k.alias("k"), canonical(x, k).alias("c"), canonical(F.col("new"), k).alias("s"))
    parts = F.transform(F.filter(_parts(x), lambda n: n.rlike(r"^\p{Lu}")), lambda n: F.struct(
        F.lit("name").alias("k"), F.lower(n).alias("c"), F.lower(_name(key, n, _female(_title(x)), width)).alias("s")))
    each = F.when(k == "person", F.concat(F.array(whole), parts)).otherwise(F.array(whole))
    return named.select(F.explode(each).alias("e")).select(
        "e.k", _hash(key, F.col("e.c")).alias("c"), _hash(key, F.col("e.s")).alias("s")).distinct()


def collisions(pairs: DataFrame) -> DataFrame:
    """Surrogates of several originals, and hashed ones equal to some original."""
    many = pairs.groupBy("k", "s").agg(F.count("*").alias("n")).where("n > 1").select("k", "s")
    hashed = pairs.where(F.col("k").isin("email", "person", "name", "iban")).select("k", "s")
    return many.union(hashed.join(pairs.select("k", F.col("c").alias("s")), ["k", "s"]))


def surrogate_width(docs: DataFrame, key: str, *, text: str = "text", width: int = 6, longest: int = 60) -> int:
    """Syllables of hashed names with which no two originals of the corpus share a surrogate."""
    while width < longest:
        if collisions(stored(surrogate_pairs(docs, key, width, text), "pii-pairs")).isEmpty():
            break
        width += 4
    return width


def replace(docs: DataFrame, *, text: str = "text", key: str, width: int | None = None) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; all other columns as they are."""
    width = surrogate_width(docs, key, text=text) if width is None else width
    t = F.col(text)

    def joined(known, pattern):
        kinds = F.transform(F.regexp_extract_all(t, pattern, 0), lambda x: F.struct(x.alias("x"), kind_of(x).alias("k")))
        new = F.concat(F.transform(kinds, lambda p: surrogate(p["x"], p["k"], key, width, known)), F.array(F.lit("")))
        return F.array_join(F.zip_with(F.split(t, pattern, -1), new, lambda a, b: F.concat(a, b)), "")

    whole = _let(known_names(t), lambda known: _let(pattern_of(known), lambda pattern: joined(known, pattern)))
    return docs.withColumn(text, F.when(t.rlike(HINT), whole).otherwise(t))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", key: str) -> DataFrame:
    """One row per document: doc_id, n_entities, text with surrogates."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(text).alias("before"))
    before = F.col("before")
    found = _let(pattern_of(known_names(before)), lambda pattern: F.regexp_extract_all(before, pattern, 0))
    n = F.when(before.rlike(HINT), F.size(found)).otherwise(0)
    return replace(src, text="text", key=key).select("doc_id", F.coalesce(n, F.lit(0)).cast("long").alias("n_entities"), "text")
