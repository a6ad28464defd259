"""PII surrogates: detected entities receive keyed, type-consistent replacements.

Detection is one regular expression: e-mail addresses, phone numbers, payment
card, social security and IPv4 numbers, labelled secrets and access key ids,
and person names after a title.  A mention is cut into entities and plain
parts (a title, ``password=``), and each distinct entity gets a surrogate from
a keyed hash of its type and canonical form, so mentions of one entity in
whatever spelling get the same one (coreference), in their own format:

* e-mail: local part by address, host labels by host, last label kept; letters
  stay letters, digits digits, case follows the mention;
* phone: the last ten digits are replaced, country code and layout kept, no
  area or exchange code begins with 0 or 1;
* card: issuer digit and layout kept, check digit right if it was;
* social security number and IPv4 address: valid ranges, private networks stay
  private;
* secret: same length, hexadecimal stays hexadecimal, known prefixes kept;
* name: title kept; given names match the title's gender, given and family
  names the script (Latin, Cyrillic); a family name alone after a title is the
  same entity as after a given name.

Collision checks: two entities of a type never share a surrogate, and no
surrogate is a real entity of the corpus (e-mail addresses as a whole: local
parts differ under one host, and no surrogate host is real); an entity that
fails is hashed again with the next attempt number until none fails (the smaller
canonical form keeps the surrogate).  A shape has a finite number of forms, so
after a few attempts the surrogate grows with each (by a character, syllable or
digit; private addresses go to 10.0.0.0/8, then addresses grow by an octet).

Only DataFrame functions are used.  Texts without any cue skip the expression
and the joins; a mention in very many documents is one row of the mapping,
whose join can be split on the documents' side.

Defined results: null text stays null, an empty text empty; rows equal in
doc_id and text are one document and get the same result; overlapping
candidates go to the leftmost, then by the order above (secrets first); a name
without a title is not detected; an empty table gives an empty result; a host
name counts up to 128 labels, what follows them stays; very long texts pass, as
every repetition in the expression is of single characters or bounded; other
columns are kept, names beginning with ``__`` are reserved and raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.common import doc_key, materialize, reserve, shuffle_parts

KEY = "surrogate-key"
GROW_AFTER = 4

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "г-жа")
NEUTRAL = ("Dr", "Prof")
_TITLE = rf"(?:{'|'.join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))})"
_NAME = r"\p{Lu}\p{Ll}+"
_LABEL = r"(?i:password|passwd|pwd|passphrase|token|secret|api[_-]?key|access[_-]?key)"
_SECRET_HEAD = rf"\b{_LABEL}\s{{0,3}}[=:]\s{{0,3}}[\"']?(?=[A-Za-z0-9+/_-]{{0,200}}[0-9])"
_KEY_ID = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?=[A-Z0-9]{16}(?![A-Za-z0-9]))"
_PATTERNS = (
    rf"{_SECRET_HEAD}[A-Za-z0-9+/_-]{{6,}}+={{0,2}}",
    rf"{_KEY_ID}[A-Z0-9]{{16}}",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",
    rf"(?<![\p{{L}}\p{{N}}-]){_TITLE}\.? {_NAME}(?: {_NAME})?",
    r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9])(?!\.[0-9])",
    r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
)
PATTERN = "|".join(_PATTERNS)
#: what every mention holds: texts without it are passed on as they are
CUE = rf"[0-9@]|(?<![\p{{L}}\p{{N}}-]){_TITLE}\.? \p{{Lu}}"

_GIVEN = {  # syllables of given names: beginning, middle, ending by gender
    "latin": ("Al Ber Cor Dar El Fer Gar Hel Jor Kel Lor Mar Nor Ol Per Ral Sel Tor Val Wil",
              "an en in ar er ir al el il on", {"m": "do us rik bert mund", "f": "da ina ette lia wyn", "x": "is ey el ar en"}),
    "cyrillic": ("Ал Бор Вал Гер Дар Ев Зар Ил Кар Лев Мар Ник Ол Пав Рад Сев Тим Фед Юл Яр",
                 "ан ен ин ар ер ир ал ел ил он", {"m": "дий мир слав тин рик", "f": "да ина ета лия ана", "x": "ис ей ел ар ен"})}
_FAMILY = {
    "latin": ("Ash Bren Cald Dun Ever Fair Glen Har Ing Kirk Lan Mor Nash Oak Pen Ros Stan Thorn Wal York",
              "a e i o u ar er or al el", "by den field ford ham ley man ner ton wick"),
    "cyrillic": ("Аш Брен Калд Дун Вер Фир Глен Гар Инг Кирк Лан Мор Наш Ок Пен Рос Стан Торн Вал Йор",
                 "а е и о у ар ер ор ал ел", "бин ден филь форд хам лей ман нер тон вик")}


def keyed(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """192 hexadecimal digits that only the key's owner can compute."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(i)), kind, attempt.cast("string"), canon), 256) for i in range(3)])


def _nibbles(h: Column, i: Column) -> Column:
    """The i-th (from 0) number 0..255 of a keyed hash, repeating."""
    return F.conv(F.substring(h, F.pmod(i, F.lit(96)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))


def _word(words: str, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words.split()]), (F.pmod(n, F.lit(len(words.split()))) + 1).cast("int"))


def reshape(value: Column, h: Column, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """``value`` (ASCII) with each letter and digit replaced by one of its kind."""
    places = F.sequence(F.lit(1), F.length(value))

    def put(i: Column) -> Column:
        c, n = F.substring(value, i, F.lit(1)), _nibbles(h, i)
        return (F.when(c.rlike("[0-9]"), _pick("0123456789", n)).when(c.rlike("[a-z]"), _pick(letters, n))
                .when(c.rlike("[A-Z]"), _pick(letters.upper(), n)).otherwise(c))

    return F.when(F.length(value) == 0, "").otherwise(F.array_join(F.transform(places, put), ""))


def _digits(n: int, h: Column, first: dict[int, str] | None = None) -> Column:
    """``n`` digits from a hash; at the given places from the given alphabets."""
    return F.concat(*[_pick((first or {}).get(i, "0123456789"), _nibbles(h, F.lit(i))) for i in range(n)])


def _luhn_sum(digits: Column) -> Column:
    """Luhn checksum of a digit string, the last digit counting once."""
    size = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((size - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), size), value), F.lit(0), lambda a, b: a + b)


def _more(n: Column, one) -> Column:
    """``n`` pieces ``one(i)`` (i from 1), joined."""
    return F.when(n <= 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one), ""))


def surrogate(kind: Column, canon: Column, h: Column, grow: Column | None = None) -> Column:
    """The surrogate's canonical form for an entity's, by type; ``grow`` pieces
    (characters, syllables, octets) longer, which makes room for any number."""
    grow = F.lit(0) if grow is None else grow
    digits = _more(grow, lambda i: _pick("0123456789", _nibbles(h, i + 47)))
    letters = _more(grow, lambda i: _pick("abcdefghijklmnopqrstuvwxyz", _nibbles(h, i + 47)))
    last = F.length(canon)
    area = {0: "23456789", 3: "23456789"}
    phone = F.when(last == 10, _digits(10, h, area)).otherwise(reshape(canon, h))
    phone = F.concat(phone, digits)
    card = F.concat(F.substring(canon, F.lit(1), F.lit(1)), reshape(F.substring(canon, F.lit(2), last - 2), h), digits)
    check = F.pmod(F.lit(10) - _luhn_sum(F.concat(card, F.lit("0"))) % 10, F.lit(10))
    card = F.concat(card, F.when(_luhn_sum(canon) % 10 == 0, check).otherwise(
        F.pmod(check + 1 + _nibbles(h, F.lit(0)) % 9, F.lit(10))).cast("string"))
    octets = F.split(canon, r"\.")
    octet = lambda i: (1 + _nibbles(h, F.lit(i)) % 254).cast("string")
    public = F.element_at(F.array(*[F.lit(str(x)) for x in range(1, 224) if x not in (10, 127, 169, 172, 192, 198, 203)]),
                          (_nibbles(h, F.lit(0)) % 216 + 1).cast("int"))
    # a private network that is full goes on in the largest one
    head = (F.when((grow > 0) & canon.rlike(r"^(10|192\.168|169\.254|172\.(1[6-9]|2[0-9]|3[01]))\."), F.concat_ws(".", F.lit("10"), octet(1)))
            .when(octets[0].isin("10", "127"), F.concat_ws(".", octets[0], octet(1)))
            .when(canon.rlike(r"^(192\.168|169\.254|172\.(1[6-9]|2[0-9]|3[01]))\."), F.concat_ws(".", octets[0], octets[1]))
            .otherwise(F.concat_ws(".", public, octet(1))))
    ip = F.concat(F.concat_ws(".", head, octet(2), octet(3)),
                  _more(grow - 1, lambda i: F.concat(F.lit("."), (1 + _nibbles(h, i + 47) % 254).cast("string"))))
    ssn = F.concat(_pick("1345", _nibbles(h, F.lit(0))), _digits(2, h, {1: "123456789"}), F.lit("-"), _pick("123456789", _nibbles(h, F.lit(4))),
                   _pick("0123456789", _nibbles(h, F.lit(5))), F.lit("-"), _pick("123456789", _nibbles(h, F.lit(6))),
                   F.substring(_digits(10, h), F.lit(7), F.lit(3)), digits)
    hexadecimal = canon.rlike("^([0-9a-f]+|[0-9A-F]+)$")
    out = (F.when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip)
           .when(kind == "ssn", ssn).when(kind == "secret", F.when(hexadecimal, F.concat(reshape(canon, h, "abcdef"), digits))
                                                     .otherwise(F.concat(reshape(canon, h), digits)))
           .when(kind.isin("local", "host"), F.concat(reshape(canon, h), letters)))
    n = lambda i: _nibbles(h, F.lit(i))
    more = F.when(n(9) % 2 == 0, "")  # names grow with the hash, so there are always enough of them
    for script in ("latin", "cyrillic"):
        syllables = lambda middle: _more(grow, lambda i: _word(middle, _nibbles(h, i + 47)))
        begin, middle, ends = _GIVEN[script]
        for gender, end in ends.items():
            out = out.when(kind == f"given-{gender}-{script}", F.concat(
                _word(begin, n(0)), _word(middle, n(1)), more.otherwise(_word(middle, n(2))), syllables(middle), _word(middle, n(4)), _word(end, n(3))))
        begin, middle, end = _FAMILY[script]
        out = out.when(kind == f"family-{script}", F.concat(
            _word(begin, n(0)), _word(middle, n(1)), _word(_FAMILY[script][2], n(2)), more.otherwise(_word(middle, n(4))), syllables(middle), _word(end, n(3))))
    return out


def mention_parts(mention: Column) -> Column:
    """The parts of a mention in order: ``kind`` (null: stays), ``raw``, ``canon``."""
    def part(kind, raw: Column, canon: Column | None = None) -> Column:
        kind = F.lit(kind) if not isinstance(kind, Column) else kind
        return F.struct(kind.cast("string").alias("kind"), raw.alias("raw"), (raw if canon is None else canon).alias("canon"))

    def script(x: Column) -> Column:
        return F.when(x.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    digits = F.regexp_replace(mention, "[^0-9]", "")
    head = F.regexp_extract(mention, rf"^(?:{_SECRET_HEAD}|AKIA|ASIA)", 0)
    local, host = F.substring_index(mention, "@", 1), F.substring_index(mention, "@", -1)
    label = F.regexp_extract(host, r"\.[^.]+$", 0)
    title = F.regexp_extract(mention, rf"^{_TITLE}\.? ", 0)
    names = F.split(F.substring(mention, F.length(title) + 1, F.length(mention)), " ")
    bare = F.regexp_replace(title, r"\.? $", "")
    gender = F.when(bare.isin(*MALE), "m").when(bare.isin(*FEMALE), "f").otherwise("x")
    family = F.element_at(names, -1)
    return (F.when(head != "", F.array(part(None, head), part("secret", F.substring(mention, F.length(head) + 1, F.length(mention)))))
            .when(mention.contains("@"), F.array(
                part("local", local, F.lower(mention)), part(None, F.lit("@")),
                part("host", F.regexp_replace(host, r"\.[^.]+$", ""), F.lower(F.regexp_replace(host, r"\.[^.]+$", ""))), part(None, label)))
            .when((title != "") & (F.size(names) == 2), F.array(
                part(None, title), part(F.concat(F.lit("given-"), gender, F.lit("-"), script(names[0])), names[0]),
                part(None, F.lit(" ")), part(F.concat(F.lit("family-"), script(family)), family)))
            .when(title != "", F.array(part(None, title), part(F.concat(F.lit("family-"), script(family)), family)))
            .when(mention.rlike(r"^[0-9]+(\.[0-9]+){3}$"), F.array(part("ip", mention)))
            .when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.array(part("ssn", mention)))
            .when(mention.rlike(r"^[0-9][0-9 -]*$") & (F.length(digits) >= 13), F.array(part("card", mention, digits)))
            .otherwise(F.array(part("phone", mention, F.substring(digits, F.greatest(F.length(digits) - 9, F.lit(1)), F.lit(10))))))


def _real_form(kind: Column, canon: Column) -> Column:
    """What a surrogate is compared by: the local part of an address alone."""
    return F.when(kind == "local", F.substring_index(canon, "@", 1)).otherwise(canon)


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canon, surrogate``: distinct surrogates, none a real entity.

    Addresses are distinct as a whole: local parts only under one host, and no
    surrogate's host is a real one.  From attempt ``GROW_AFTER`` on surrogates
    grow by a piece an attempt, so the loop ends however full a shape is."""
    # surrogates are long expressions: dealt over a stated number of tasks, as few small rows would share one
    spread = lambda df: df.repartition(shuffle_parts(df.sparkSession), "kind", "canon")
    held = materialize(spread(entities.select("kind", "canon").distinct()).withColumn("attempt", F.lit(0)), "entities")
    real = held.filter("kind <> 'local'").select(F.col("kind").alias("real_kind"), F.col("canon").alias("real")).distinct()
    form = _real_form(F.col("kind"), F.col("canon"))
    while True:
        h = keyed(F.col("kind"), F.col("canon"), F.col("attempt"), key)
        made = (held.withColumn("h", h).withColumn("surrogate", surrogate(
            F.col("kind"), form, F.col("h"), F.greatest(F.col("attempt") - (GROW_AFTER - 1), F.lit(0)))).drop("h")
            .withColumn("under", F.when(F.col("kind") == "local", F.substring_index("canon", "@", -1)).otherwise("")))
        order = Window.partitionBy("kind", "under", "surrogate").orderBy("attempt", "canon")
        own = (F.col("kind") == "local") & (F.col("surrogate") == form)
        tried = materialize(
            made.withColumn("copy", F.row_number().over(order) > 1)
            .join(real.hint("merge"), (F.col("kind") == F.col("real_kind")) & (F.col("surrogate") == F.col("real")), "left")
            .select("kind", "canon", "surrogate", "attempt", (F.col("copy") | own | F.col("real").isNotNull()).alias("bad")), "surrogates")
        if not tried.filter("bad").limit(1).count():
            return tried.select("kind", "canon", "surrogate")
        held = spread(tried.select("kind", "canon", (F.col("attempt") + F.col("bad").cast("int")).alias("attempt")))


def place(kind: Column, raw: Column, made: Column) -> Column:
    """The surrogate in the mention's format: digits into its layout from the
    right, letters in its case; what the surrogate is longer follows the mention."""
    n = F.length(F.regexp_replace(raw, "[^0-9]", ""))
    k = F.when(kind == "phone", F.least(n, F.lit(10))).otherwise(n)  # digits of the canonical form
    seen = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^0-9]", ""))

    def digit(i: Column) -> Column:
        c, at = F.substring(raw, i, F.lit(1)), seen(i) - (n - k)
        return F.when(c.rlike("[0-9]") & (at >= 1), F.substring(made, at, F.lit(1))).otherwise(c)

    def letter(i: Column) -> Column:
        c, m = F.substring(raw, i, F.lit(1)), F.substring(made, i, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(m)).otherwise(m)

    over = lambda f, size: F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), f), ""),
                                    F.substring(made, size + 1, F.length(made)))
    return F.when(kind.isin("phone", "card"), over(digit, k)).when(kind.isin("local", "host"), over(letter, F.length(raw))).otherwise(made)


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Every row of ``docs`` with surrogates in ``text``, plus ``__n_entities``."""
    reserve(docs)
    # only these texts meet the expression; they are written once with their mentions
    found = materialize(docs.filter(F.col("text").rlike(CUE))
                        .withColumn("__mentions", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
                        .withColumn("__key", doc_key()), "mentions")
    holds = F.size("__mentions") > 0
    mentions = (found.filter(holds).dropDuplicates(["__key"]).select("__key", F.posexplode("__mentions").alias("__at", "__mention")))
    distinct = materialize(mentions.select(F.col("__mention").alias("mention")).distinct()
                           .select("mention", F.posexplode(mention_parts(F.col("mention"))).alias("at", "part"))
                           .select("mention", "at", "part.kind", "part.raw", "part.canon"), "parts")
    made = assign(distinct.filter("kind is not null"), key)
    parts = (distinct.join(made.hint("merge"), ["kind", "canon"], "left")
             .withColumn("new", F.when(F.col("kind").isNull(), F.col("raw")).otherwise(place(F.col("kind"), F.col("raw"), F.col("surrogate")))))
    new = materialize(parts.groupBy("mention").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda p: p["new"]), "").alias("__new"),
        F.count("kind").alias("__entities")), "replacements").withColumnRenamed("mention", "__mention")
    # by document: bounded by its own mentions
    news = (mentions.join(new.hint("merge"), "__mention").groupBy("__key")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("__at", "__new"))), lambda p: p["__new"]).alias("__news"),
                 F.sum("__entities").alias("__n")).withColumnRenamed("__key", "__doc"))
    gaps = F.split("text", PATTERN, -1)
    spliced = F.array_join(F.zip_with(gaps, F.concat("__news", F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    none = F.lit(0).cast("long")
    with_any = (found.filter(holds).join(news.hint("merge"), F.col("__key") == F.col("__doc"))
                .withColumn("text", spliced).withColumn("__n_entities", F.col("__n").cast("long")).select(*docs.columns, "__n_entities"))
    return (docs.filter(~F.coalesce(F.col("text").rlike(CUE), F.lit(False))).withColumn("__n_entities", none)
            .unionByName(found.filter(~holds).select(*docs.columns, none.alias("__n_entities")))
            .unionByName(with_any))
