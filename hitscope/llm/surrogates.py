"""Personal data replaced by surrogates (operator 6). DataFrame functions only.

Detected entities (e-mail addresses, telephone, card, account and identity numbers, network
addresses, access keys, passwords, and names after a form of address) get surrogates derived
from a secret key: of the same kind, length, script and format, with the check digits of card and
account numbers right, and names of the same gender (of the form of address, else of the given
name). A number like a card's without its check digit, a single plain word after "password:" and
a version number are not entities. The same entity gets the same surrogate everywhere (coreference),
also where it is written in another letter case, with other separators or with a full stop after the title;
"Mr. Smith" and "Mr. John Smith" count as two. Different ones get different surrogates: entities
whose surrogates agree, or agree with an entity that occurs, are drawn again, all but the
first by the order of their attempts, until no two agree. After ``IN_FORMAT`` attempts a surrogate gets
longer with each further one (names by a syllable, the others by a keyed digit), so that no
format, however short, is used up.

Only documents with entities are shuffled. An entity that occurs in very many documents is
one row of the table of entities; joins with it can be split by Spark.

Defined results: null text stays null; a text without entities stays as it is; repeated rows each
give a row, with equal results; where two kinds fit, the earlier in ``KINDS`` holds; an empty
table gives an empty table; a text of any length is searched whole in time linear in its length (an e-mail address has at
most 255 characters before the @); only doc_id and the text column are read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hitscope.session import scratch_path

# What entities look like, the more specific before the more general.
KINDS = {
    # every repetition is bounded and starts at the edge of a word: a matcher that recurses or tries again ends soon on any text
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,254}+@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.){1,16}[A-Za-z]{2,24}",
    "password": r"(?i:password|passwd|pwd|secret|api_?key|token)[ ]?[=:][ ]?[^\s\"',;]{6,}",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "hex_key": r"\b(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32})\b",
    "account": r"\b[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?\b",
    "network": r"(?<![0-9.])(?<!(?i:version|release) )(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "identity": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ \-]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![0-9])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "name": r"\b(?:Mr|Mrs|Ms|Miss|Dr|Sr|Sra|Srta|Mme|Mlle|Herr|Frau|Monsieur|Madame|Mademoiselle|Señor|Señora|Señorita|Господин|Госпожа)\.? \p{Lu}[\p{L}'\-]+(?: \p{Lu}[\p{L}'\-]+)?",
}
# Forms of address by gender, and given names and syllables to build surrogates of.
FEMALE = ["Mrs", "Ms", "Miss", "Sra", "Srta", "Mme", "Mlle", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Госпожа"]
GIVEN = {
    "female": ["Anna", "Clara", "Elena", "Emma", "Eva", "Ida", "Julia", "Laura", "Lena", "Maria", "Marta", "Nina", "Nora", "Olga", "Paula", "Rosa", "Sara", "Sofia", "Vera", "Zoe"],
    "male": ["Adam", "Albert", "Bruno", "Daniel", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Lucas", "Martin", "Oscar", "Paul", "Peter", "Simon", "Tomas", "Victor"],
    "female_cyrillic": ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "София", "Юлия", "Яна"],
    "male_cyrillic": ["Антон", "Борис", "Виктор", "Иван", "Лев", "Максим", "Олег", "Павел", "Роман", "Фёдор"],
}
SYLLABLES = ["ba", "bel", "dor", "fen", "gar", "hol", "ka", "len", "lin", "mar", "mon", "nor", "per", "ral", "rin", "sal", "sto", "tal", "ven", "wes"]
SYLLABLES_CYRILLIC = ["ба", "бел", "вол", "гор", "дар", "жу", "зим", "ка", "лен", "мар", "мор", "нов", "пет", "рал", "сол", "сто", "тал", "фен", "хол", "чер"]
#: Letters and digits beyond ASCII: what they match, and the first and number of the code points that replace them.
ALPHABETS = [
    (r"[\p{IsCyrillic}&&\p{Lu}]", 0x410, 32), (r"[\p{IsCyrillic}&&\p{Ll}]", 0x430, 32), (r"[\p{IsLatin}&&\p{Lu}]", 0xC0, 23), (r"[\p{IsLatin}&&\p{Ll}]", 0xE0, 23),
    (r"[\p{IsGreek}&&\p{Lu}]", 0x391, 17), (r"[\p{IsGreek}&&\p{Ll}]", 0x3B1, 17), (r"[\p{IsArmenian}&&\p{Lu}]", 0x531, 38), (r"[\p{IsArmenian}&&\p{Ll}]", 0x561, 38),
    (r"[\p{IsHan}&&\p{L}]", 0x4E00, 20_000), (r"[\p{IsHangul}&&\p{L}]", 0xAC00, 11_172), (r"[\p{IsHiragana}&&\p{L}]", 0x3042, 80), (r"[\p{IsKatakana}&&\p{L}]", 0x30A2, 80),
    (r"[\p{IsArabic}&&\p{L}]", 0x628, 19), (r"[\p{IsHebrew}&&\p{L}]", 0x5D0, 27), (r"[\p{IsDevanagari}&&\p{L}]", 0x915, 37), (r"[\p{IsBengali}&&\p{L}]", 0x995, 20),
    (r"[\p{IsThai}&&\p{L}]", 0xE01, 46), (r"[\p{IsGeorgian}&&\p{L}]", 0x10D0, 33), (r"[\x{660}-\x{669}]", 0x660, 10), (r"[\x{6F0}-\x{6F9}]", 0x6F0, 10),
    (r"[\x{966}-\x{96F}]", 0x966, 10), (r"[\x{FF10}-\x{FF19}]", 0xFF10, 10), (r"\p{Nd}", 0x30, 10), (r"\p{Lu}", 0x41, 26), (r"\p{L}", 0x61, 26),
]
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without any of these has no entity, and the full pattern is not tried on it.
HINT = r"[0-9@]|\b(?:Mr|Mrs|Ms|Miss|Dr|Sr|Sra|Srta|Mme|Mlle|Herr|Frau|Monsieur|Madame|Mademoiselle|Señor|Señora|Señorita|Господин|Госпожа)\b|(?i:password|passwd|pwd|secret|key|token)[ ]?[=:]"
#: Numbers that only the last digit can tell from other numbers, and values of a password that are plain words.
CARD_LIKE = r"^(?:(?:[0-9]{4}[ \-]){3}[0-9]{4}|[0-9]{13,19})$"
PLAIN_WORD = r"^(?i:password|passwd|pwd|secret|api_?key|token)[ ]?[=:][ ]?[A-Za-z][a-z]{0,12}[.!?):]*$"
MALE = ["Mr", "Sr", "Herr", "Monsieur", "Señor", "Господин"]
_BLOCKS = 4
#: Attempts that keep the length of the entity, or a name's four syllables.
IN_FORMAT = 4


def matches(text: Column) -> Column:
    """What the patterns find in a text, in order."""
    nothing = F.array().cast("array<string>")
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(nothing)


def is_private(match: Column) -> Column:
    """Numbers like a card's must have a card's check digit; a single plain word is no secret."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    return F.when(match.rlike(CARD_LIKE), _luhn(digits) % 10 == 0).otherwise(~match.rlike(PLAIN_WORD))


def found(text: Column) -> Column:
    """The entities of a text, in order."""
    return F.filter(matches(text), is_private)


def canonical(kind: Column, entity: Column) -> Column:
    """What entities that mean the same share: letter case of e-mail addresses and names, separators of numbers and the full stop of a title do not count."""
    compact = F.regexp_replace(entity, r"[ .()\-]", "")
    name = F.lower(F.regexp_replace(entity, r"^(\p{L}+)\.? ", "$1 "))
    return F.when(kind == "email", F.lower(entity)).when(kind == "name", name).when(kind.isin("phone", "card", "account", "identity"), compact).otherwise(entity)


def kind_of(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        out = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return F.coalesce(out, F.lit("other"))


def _draws(key: str, *what: Column) -> Column:
    """Hexadecimal digits that depend on the key: 128 for each of _BLOCKS blocks."""
    return F.concat(*[F.sha2(F.concat_ws("\x00", F.lit(key), F.lit(str(b)), *[w.cast("string") for w in what]), 512) for b in range(_BLOCKS)])


def _number(draws: Column, at: Column | int, digits: int = 6) -> Column:
    start = (F.lit(at) if isinstance(at, int) else at) * 2 % (128 * _BLOCKS - digits) + 1
    return F.conv(draws.substr(start.cast("int"), F.lit(digits)), 16, 10).cast("long")


def _pick(listed: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, listed)), (number % len(listed) + 1).cast("int"))


def _redrawn(value: Column, draws: Column, any_script: bool = False) -> Column:
    """Digits for digits and letters for letters of the same case and script; the rest stays. All-hexadecimal values stay so.

    With ``any_script`` also beyond ASCII: a script without an alphabet here gets Latin letters, and a value without
    digits or letters becomes lower-case letters and digits. The other kinds have ASCII digits or letters only.
    """
    drawable = value.rlike(r"[\p{L}\p{Nd}]")
    hexadecimal = value.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{12,}$")
    characters = F.split(value, "")

    def one(c: Column, i: Column) -> Column:
        n = _number(draws, i)
        of = lambda first, size: F.char(F.lit(ord(first)) + n % size)
        ascii_only = (
            F.when(hexadecimal & c.rlike("[0-9a-f]"), F.substring(F.lit("0123456789abcdef"), (n % 16 + 1).cast("int"), F.lit(1)))
            .when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[A-Z]"), of("A", 26))
            .when(c.rlike("[a-z]"), of("a", 26))
        )
        if not any_script:
            return ascii_only.otherwise(c)
        beyond = c
        for letters, first, size in reversed(ALPHABETS):
            point = F.lpad(F.hex(F.lit(first) + n % size), 4, "0")
            beyond = F.when(c.rlike(letters), F.decode(F.unhex(point), "UTF-16BE")).otherwise(beyond)
        blank = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz0123456789"), (n % 36 + 1).cast("int"), F.lit(1))
        return ascii_only.when(~drawable, blank).when(c.rlike(r"^\p{ASCII}$"), c).otherwise(beyond)

    return F.array_join(F.transform(characters, one), "")


def _spread(compact: Column, like: Column) -> Column:
    """The letters and digits of ``compact`` in the format of ``like``."""
    place = lambda i: F.char_length(F.regexp_replace(F.substring(like, F.lit(1), i + 1), "[^A-Za-z0-9]", ""))
    return F.array_join(F.transform(F.split(like, ""), lambda c, i: F.when(c.rlike("[A-Za-z0-9]"), F.substring(compact, place(i), F.lit(1))).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has divisible by ten."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))),
        F.lit(0),
        lambda total, x: total + x,
    )


def _mod97(account: Column) -> Column:
    """The remainder that a valid account number has 1 of; four characters go to the end, letters count from 10."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    return F.aggregate(
        turned, F.lit(0), lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + F.ascii(c) - 48) % 97).when(c.rlike("[A-Z]"), (r * 100 + F.ascii(c) - 55) % 97).otherwise(r)
    )


def _with_last_digits(value: Column, last: Column, pattern: str) -> Column:
    return F.regexp_replace(value, pattern, F.concat(F.lit("$1"), last))


def _host(entity: Column) -> Column:
    return F.regexp_extract(F.substring_index(entity, "@", -1), r"^(.*)\.[A-Za-z]+$", 1)


def surrogate(kind: Column, entity: Column, attempt: Column, draws: Column, host_draws: Column) -> Column:
    """The surrogate made of keyed ``draws``; these are columns of their own, or they would be made again for every character."""
    more = F.greatest(attempt - (IN_FORMAT - 1), F.lit(0))
    tail = F.array_join(F.transform(_upto(more), lambda i: (_number(draws, 70 + 3 * i) % 10).cast("string")), "")
    plain = _redrawn(entity, draws)
    compact = F.regexp_replace(entity, "[^A-Za-z0-9]", "")
    rest = lambda value, first: F.substring(value, F.lit(first), F.char_length(value))
    domain = F.substring_index(entity, "@", -1)
    host = _host(entity)
    local = _redrawn(F.substring_index(entity, "@", 1), draws)
    email = F.concat(local, tail, F.lit("@"), _redrawn(host, host_draws), F.regexp_extract(domain, r"(\.[A-Za-z]+)$", 1))
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.when(i == 0, 1).otherwise(0) + _number(draws, i * 8) % F.when(i == 0, 223).otherwise(256)).cast("string"))
    # the first digit stays, and the last makes the number as valid as it was
    card = F.concat(F.substring(compact, 1, 1), _redrawn(rest(compact, 2), draws))
    short = _luhn(F.concat(F.substring(card, F.lit(1), F.char_length(card) - 1), F.lit("0")))
    right = (10 - short % 10) % 10
    last = F.when(_luhn(compact) % 10 == 0, right).otherwise((right + 1 + _number(draws, 60) % 9) % 10)
    card = _spread(_with_last_digits(card, last.cast("string"), "^(.*)[0-9]$"), entity)
    blank = F.concat(F.substring(compact, 1, 2), F.lit("00"), _redrawn(rest(compact, 5), draws))
    check = F.lpad((98 - _mod97(blank)).cast("string"), 2, "0")
    checked = F.concat(F.substring(compact, 1, 2), check, rest(blank, 5))
    account = _spread(F.when(_mod97(compact) == 1, checked).otherwise(F.concat(F.substring(compact, 1, 2), _redrawn(rest(compact, 3), draws))), entity)
    prefix = F.regexp_extract(entity, r"^(\+[0-9]{1,3})[ .\-(]", 1)
    local_number = F.substring(entity, F.char_length(prefix) + 1, F.char_length(entity))
    phone = F.concat(prefix, _spread(_redrawn(F.regexp_replace(local_number, "[^0-9]", ""), draws), local_number))
    secret = r"^((?i:password|passwd|pwd|secret|api_?key|token)[ ]?[=:][ ]?)"
    label = F.regexp_extract(entity, secret, 1)
    password = F.concat(label, _redrawn(F.substring(entity, F.char_length(label) + 1, F.char_length(entity)), draws, any_script=True))
    access = F.concat(F.substring(entity, 1, 4), _redrawn(F.substring(entity, F.lit(5), F.char_length(entity)), draws))
    like_entity = (
        F.when(kind == "network", F.array_join(octets, "."))
        .when(kind == "card", card)
        .when(kind == "account", account)
        .when(kind == "phone", phone)
        .when(kind == "identity", _spread(_redrawn(compact, draws), entity))
        .when(kind == "password", password)
        .when(kind == "access_key", access)
        .otherwise(plain)
    )
    # an x before the digits keeps them apart from those of the format
    longer = F.concat(like_entity, F.when(more > 0, F.concat(F.lit("x"), tail)).otherwise(""))
    return F.when(kind == "email", email).when(kind == "name", _name(entity, draws, more)).otherwise(longer)


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _name(entity: Column, draws: Column, more: Column) -> Column:
    """The form of address with a name of its gender, in its script, with as many words and the same capitals; its family name has four syllables and ``more``."""
    title = F.regexp_extract(entity, r"^(\p{L}+\.? )", 1)
    words = F.split(F.substring(entity, F.char_length(title) + 1, F.char_length(entity)), " ")
    form = F.regexp_replace(title, r"\.? $", "")
    # a form of address without a gender leaves it to the given name
    female = form.isin(FEMALE) | (~form.isin(MALE) & (F.size(words) > 1) & (F.initcap(words[0]).isin(GIVEN["female"]) | words[0].rlike("[aAаА]$")))
    cyrillic = words[0].rlike(r"^\p{IsCyrillic}")
    given = F.lit(None).cast("string")
    for script, is_script in (("", ~cyrillic), ("_cyrillic", cyrillic)):
        for gender, is_gender in (("female", female), ("male", ~female)):
            given = F.when(is_script & is_gender, _pick(GIVEN[gender + script], _number(draws, 3))).otherwise(given)
    syllable = lambda n: F.when(cyrillic, _pick(SYLLABLES_CYRILLIC, n)).otherwise(_pick(SYLLABLES, n))
    parts = [syllable(_number(draws, 20 + 9 * k)) for k in range(4)]
    family = F.concat(F.initcap(parts[0]), *parts[1:], F.array_join(F.transform(_upto(more), lambda i: syllable(_number(draws, 60 + 9 * i))), ""))
    like = lambda new, old: F.when((old == F.upper(old)) & (F.char_length(old) > 1), F.upper(new)).otherwise(new)
    return F.concat(title, F.when(F.size(words) > 1, F.concat_ws(" ", like(given, words[0]), like(family, words[1]))).otherwise(like(family, words[0])))


def _table(entities: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate: distinct for distinct entities, and none that occurs as an entity."""
    spark = entities.sparkSession
    # drawing is work per row and not per byte, so its tasks are not merged by their size
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64("entity")  # entities come hashed already, and a second exchange by the same key would be left out
    drawn = entities.select(kind_of(F.col("entity")).alias("kind"), "entity", F.lit(0).alias("attempt"))
    while True:  # each attempt past IN_FORMAT has a larger space, so this ends
        path = scratch_path(spark, "surrogates")
        drawn = drawn.repartition(tasks, spread).withColumn("same", canonical(F.col("kind"), F.col("entity")))
        drawn = drawn.withColumn("draws", _draws(key, F.col("kind"), F.col("same"), F.col("attempt"))).withColumn("host_draws", _draws(key, F.lit("domain"), F.lower(_host(F.col("entity")))))
        made = surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), F.col("draws"), F.col("host_draws"))
        drawn.select("kind", "entity", "attempt", "same", made.alias("surrogate")).write.parquet(path)
        table = spark.read.parquet(path)
        order = Window.partitionBy("surrogate").orderBy("attempt", F.sha2("entity", 256))
        occurs = table.select(F.col("entity").alias("other"), F.lit(True).alias("occurs"))
        ranked = table.withColumn("place", F.row_number().over(order)).join(occurs, F.col("surrogate") == F.col("other"), "left")
        again = (F.col("place") > 1) | F.col("occurs").isNotNull()
        if ranked.where(again).isEmpty():
            return table.select("kind", "entity", "surrogate")
        # entities that mean the same are drawn again together
        same = Window.partitionBy("kind", "same")
        drawn = ranked.select("kind", "entity", (F.max("attempt").over(same) + F.max(again.cast("int")).over(same)).alias("attempt"))


def replace(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """doc_id, text with surrogates, n_replaced of every row."""
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id"), F.col(text).alias("text"))
    path = scratch_path(spark, "private_texts")
    private = source.withColumn("matches", matches(F.col("text"))).withColumn("entities", F.filter("matches", is_private)).where(F.size("entities") > 0)
    private.withColumn("row", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))).write.parquet(path)
    private = spark.read.parquet(path)
    occurring = private.select("row", F.explode(F.array_distinct("entities")).alias("entity")).distinct()
    table = _table(occurring.select("entity").distinct(), key)
    pairs = occurring.join(table, "entity").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("by_entity"))
    between = F.split("text", ANY, -1)
    instead = F.transform("matches", lambda e: F.coalesce(F.try_element_at("by_entity", e), e))
    # both arrays are made once a row; inside a function of a piece they would be made for every piece
    rebuilt = F.array_join(F.zip_with(between, instead, lambda piece, e: F.concat(F.coalesce(piece, F.lit("")), F.coalesce(e, F.lit("")))), "")
    changed = private.join(pairs, "row").withColumn("instead", instead).select("doc_id", rebuilt.alias("text"), F.size("entities").cast("long").alias("n_replaced"))
    same = source.where(F.coalesce(F.size(found(F.col("text"))) == 0, F.lit(True))).select("doc_id", "text", F.lit(0).cast("long").alias("n_replaced"))
    return same.union(changed)
