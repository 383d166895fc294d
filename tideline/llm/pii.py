"""Personal data: detected entities get keyed surrogates of the same type, gender, script and format.

Detected are e-mail addresses, IBANs (in capitals, or in small letters with digits after the bank's code), social security
numbers, IP addresses of both versions, phone and card numbers, and names: after a title, a known given name or a phrase that
names are given after (`My name is`), maybe with initials and particles (van, de la). Words of a name begin with a capital and
may have more of them (McDonald), an apostrophe (O'Brien), hyphens (Smith-Jones: two entities) or capitals only. A name has a
given name (with its gender) and a family name, entities of their own, so "Mr. John Smith" and "Mr. Smith" share the surrogate
of Smith, and Mr. and Mrs. Alex Kim share that of Kim alone. In a text with names every other word that begins with a
capital and is a part of one of them is a mention too ("Later Smith left"); where it is both, it is a family name. An entity
is known by its normalised form (case, separators and the two ways to write an IPv6 address don't count), and has one
surrogate in all texts: coreference holds.

Surrogates come from a keyed hash. Letters become letters of the same script and case, digits digits, and separators stay. An
e-mail address keeps its top-level domain, a phone number its country code, a card its first digit and its Luhn remainder, an
IBAN its country and its remainder modulo 97, an IP address the number of digits of its parts and an IPv6 address its zero
groups. A given name becomes one of its gender and script, a family name one of its script; titles, initials, particles,
O', Mc and Mac stay.

Distinctness: over all entities of all texts, a surrogate that two entities share, or that is itself an entity of the
texts, is drawn again for all but the least of them, until none is left. Spaces grow with the attempts, so this ends: names get
more syllables, after WIDER attempts numbers and addresses get more digits or letters, and IP addresses parts of any length;
after LAST attempts (the texts then hold a good part of all IP addresses of that form) they become whole IPv6 addresses.

Texts without entities don't move. Those with some are keyed by digest, so copies are handled once; entities are joined
with their surrogates and a text's surrogates are gathered by text. Very long texts and entities are handled whole (a domain
has 127 parts and a name 8 joined by hyphens at most). Null texts stay null, empty ones empty; every row gives one row; columns
besides the two named are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import dropped, settled, table

KINDS = ("email", "iban", "ssn", "ip", "phone", "card", "name")
WIDER, LAST = 6, 40
MALE, FEMALE, EITHER = r"Mr\.?|Herrn?|Señor|Monsieur|Господин|Κύριος", r"Mrs\.?|Ms\.?|Frau|Señora|Madame|Mme|Госпожа|Κυρία", r"Dr\.?|Prof\.?"
#: In capitals only titles with a full stop and whole words count (MS may be anything).
MALE, FEMALE, EITHER = rf"{MALE}|MR\.|HERRN?|SEÑOR|MONSIEUR|ГОСПОДИН", rf"{FEMALE}|MRS\.|MS\.|FRAU|SEÑORA|MADAME|ГОСПОЖА", rf"{EITHER}|DR\.|PROF\."
TITLE = f"{MALE}|{FEMALE}|{EITHER}"
#: Given names by gender and script (Latin, Cyrillic, Greek): known ones, and first choices for surrogates. Fixed values.
GIVEN = {
    "mL": "James Robert Michael David Thomas Daniel Paul Peter Martin Felix Lukas Jonas Hugo Louis Carlos Diego John William George Charles Hans Klaus Pierre Jean Luis Juan Ahmed Mohammed Omar Hassan Ali Wei Jun Hiroshi Kenji Takashi Raj Arjun Rahul Sanjay Vikram Chidi Kwame Mehmet Emre Marco Luca Giovanni Piotr Tomasz Lars Erik".split(),
    "fL": "Mary Linda Susan Karen Laura Julia Anna Clara Emma Sofia Marta Lucia Camille Louise Elena Ines Elizabeth Sarah Jane Alice Ingrid Petra Marie Sophie Carmen Rosa Fatima Aisha Leila Mei Ling Xiu Yuki Sakura Akiko Priya Anjali Deepa Sunita Lakshmi Amara Ngozi Ayse Zeynep Giulia Chiara Agnieszka Katarzyna Astrid Freya".split(),
    "mC": "Иван Пётр Сергей Андрей Максим Олег Павел Юрий Николай Дмитрий".split(),
    "fC": "Анна Мария Ольга Елена Ирина Нина Вера Юлия Татьяна Светлана".split(),
    "mG": "Γιώργος Νίκος Δημήτρης Κώστας Πέτρος Αντώνης".split(),
    "fG": "Μαρία Ελένη Κατερίνα Σοφία Άννα Δήμητρα".split(),
}
SYLLABLES = {
    "L": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se ta te".split(),
    "C": "ба бе бо ва ве во га го да де до за зе ка ко ла ле ло ма ме мо на не но па ра ре ро са се та те".split(),
    "G": "βα βε βο γα γο δα δε δο ζα κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε".split(),
}
#: What made-up given names end in.
ENDINGS = {"mL": "n r s ldo".split(), "fL": "na la ra lia".split(), "mC": "н р м слав".split(), "fC": "на ла ра лия".split(), "mG": "ς νος ρος κης".split(), "fG": "να λα ρα νη".split()}
#: Letters by script, small ones and capitals (the same where a script has none).
ALPHABETS = (
    (r"\p{IsLatin}", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{IsHebrew}", *["אבגדהוזחטילמנסעפצקרשת"] * 2),
    (r"\p{IsArabic}", *["ابتثجحخدذرزسشصضطظعغفقكلمنهوي"] * 2),
    (r"\p{IsHan}", *["山川田中大小上下東西南北春夏秋冬木林森石金水火土日月"] * 2),
    (r"\p{IsHiragana}", *["あいうえおかきくけこさしすせそたちつてとなにぬねの"] * 2),
    (r"\p{IsKatakana}", *["アイウエオカキクケコサシスセソタチツテトナニヌネノ"] * 2),
    (r"\p{IsHangul}", *["가나다라마바사아자차카타파하고노도로모보소오조초코토포호"] * 2),
)
_SEP = r"[ .-]?"
_KNOWN = "|".join(n for names in GIVEN.values() for own in names for n in (own, own.upper()))
#: A word of a name as it is replaced, and words that hyphens join; what may stand between names.
WORD = r"(?:\p{L}['’])?\p{Lu}[\p{L}\p{M}]++"
_JOINED = rf"{WORD}(?:-{WORD}){{0,7}}"
_BETWEEN = r"(?: \p{Lu}\.)?(?: (?:van|von|der|den|de|del|della|da|di|du|la|le|al|el|bin|ibn|ter|ten|zu|dos|das)(?= )){0,3}"
#: Names stand after these. Fixed values.
CUES = ("My name is ", "my name is ", "Name: ", "name: ", "Signed by ", "signed by ", "Signed, ", "signed, ", "Sincerely, ", "sincerely, ", "Regards, ", "regards, ")
_START = r"(?<![\p{L}\p{M}\p{N}])"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])(?<![\p{L}\p{N}]['])[\p{L}\p{N}._%+-][\p{L}\p{N}._%+'-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,127}",
    "iban": r"(?<![\p{L}\p{N}])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[a-z]{4})?(?: ?[0-9]{4}){2,7}(?: ?[0-9]{1,3})?)(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\p{L}\p{N}]|\.[0-9])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f]{{1,4}}:)(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "phone": rf"(?<![\p{{L}}\p{{N}}+])(?:\+[0-9]{{1,3}}{_SEP}\(?[0-9]{{2,4}}\)?(?:{_SEP}[0-9]{{2,4}}){{2,4}}|\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}})(?![\p{{L}}\p{{N}}])",
    "card": r"(?<![\p{L}\p{N}])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
    "name": rf"{_START}(?:(?:{TITLE}) {_JOINED}(?:{_BETWEEN} {_JOINED})?|(?=\p{{Lu}})(?:{_KNOWN})(?:-{WORD}){{0,7}}{_BETWEEN} {_JOINED}|(?<={'|'.join(CUES)}){_JOINED}{_BETWEEN} {_JOINED})(?![\p{{L}}\p{{N}}])",
}
#: One pattern for all; what an earlier kind takes, a later one doesn't.
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: The same and all words that may be a part of a name.
ANY_WORD = f"{ANY}|(?:{_START}{WORD})"
#: Some entity can only be in a text with one of these.
MAY = rf"@|[0-9][0-9 ().-]{{5,}}[0-9]|[A-Z]{{2}}[0-9]{{2}} ?[A-Z0-9]|[a-z]{{2}}[0-9]{{2}} ?[a-z0-9]{{4}} ?[0-9]{{4}}|{_HEX}:(?:{_HEX})?:|{_START}(?=\p{{Lu}})(?:{TITLE}|{_KNOWN})[ -]|{'|'.join(CUES)}"
#: The calling codes of countries that have one or two digits; all others have three. Fixed values.
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _hashed(key: str, kind: Column, entity: Column, attempt: Column, salt: Column) -> Column:
    """Eight hex digits of a keyed digest, as a number."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"), salt.cast("string"), F.lit(key)), 256), 1, 8), 16, 10).cast("bigint")


def kind_of(value: Column) -> Column:
    """The kind of a match of ANY_WORD: one of KINDS, or word."""
    out = F.when(F.regexp_like(value, F.lit(f"^{WORD}$")), "word")
    for k, p in PATTERNS.items():
        if k != "name":
            out = out.when(F.regexp_like(value, F.lit(f"^(?:{p})$")), k.removesuffix("6"))
    return out.otherwise("name")


def _one(options: str, n: Column) -> Column:
    """The n-th (modulo their number) of these letters."""
    return F.substr(F.lit(options), (F.pmod(n, F.lit(len(options))) + 1).cast("int"), F.lit(1))


def _pick(words: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (F.pmod(n, F.lit(len(words))) + 1).cast("int"))


def _script(word: Column) -> Column:
    return F.when(F.regexp_like(word, F.lit(r"^\p{IsCyrillic}")), "C").when(F.regexp_like(word, F.lit(r"^\p{IsGreek}")), "G").otherwise("L")


def _letters(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """entity with each letter replaced by one of its script and case and each digit by a digit, by its place."""
    signs = F.filter(F.split(entity, ""), lambda c: c != "")

    def sign(c: Column, n: Column) -> Column:
        h = _hashed(key, kind, entity, attempt, n)
        out = F.when(F.regexp_like(c, F.lit(r"\p{Nd}")), F.when(n == 0, 1 + F.pmod(h, F.lit(9))).otherwise(F.pmod(h, F.lit(10))).cast("string"))
        for script, small, capital in ALPHABETS:
            own = F.regexp_like(c, F.lit(script)) & F.regexp_like(c, F.lit(r"\p{L}"))
            out = out.when(own & F.regexp_like(c, F.lit(r"\p{Lu}")), _one(capital, h)).when(own, _one(small, h))
        return out.when(F.regexp_like(c, F.lit(r"\p{L}")), _one(ALPHABETS[0][1], h)).otherwise(c)

    return F.array_join(F.transform(signs, sign), "")


def _more(attempt: Column, filler: str) -> Column:
    """What an entity is made longer by, once its space seems full."""
    return F.repeat(F.lit(filler), F.greatest(F.lit(0), attempt - WIDER + 1).cast("int"))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    signs = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    each = F.transform(signs, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10


def _card(entity: Column, drawn: Column) -> Column:
    """The first digit stays, the last makes the Luhn remainder the same, those between are drawn."""
    body = F.concat(F.substring(entity, 1, 1), F.substr(drawn, F.lit(2), F.length(drawn) - 2))
    return F.concat(body, F.pmod(_luhn(entity) - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))


def _mod97(text: Column) -> Column:
    """The remainder of an IBAN's number: its first four signs moved to the end, letters as 10 to 35."""
    signs = F.filter(F.split(F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4)), ""), lambda c: c != "")
    digit = F.regexp_like
    return F.aggregate(signs, F.lit(0), lambda n, c: F.when(digit(c, F.lit("[0-9]")), n * 10 + c.cast("int")).otherwise(n * 100 + F.ascii(c) - 55) % 97)


def _iban(entity: Column, drawn: Column) -> Column:
    """The country stays, and check digits make the remainder the same."""
    country, body = F.substring(entity, 1, 2), F.substr(drawn, F.lit(5))
    check = F.pmod(_mod97(entity) - _mod97(F.concat(country, F.lit("00"), body)), F.lit(97))
    return F.concat(country, F.lpad(F.when(check < 2, check + 97).otherwise(check).cast("string"), 2, "0"), body)


def _ip(key: str, entity: Column, attempt: Column) -> Column:
    """Parts of as many digits, below 256; after WIDER attempts of any number of digits. The same for IPv6, whose zero groups stay. After LAST attempts a whole IPv6 address."""
    h = lambda i: _hashed(key, F.lit("ip"), entity, attempt, i)
    narrow = lambda p, i: F.when(F.length(p) == 3, 100 + F.pmod(h(i), F.lit(156))).when(F.length(p) == 2, 10 + F.pmod(h(i), F.lit(90))).otherwise(1 + F.pmod(h(i), F.lit(9)))
    four = F.array_join(F.transform(F.split(entity, r"\."), lambda p, i: F.when(attempt >= WIDER, F.pmod(h(i), F.lit(256))).otherwise(narrow(p, i)).cast("string")), ".")
    # a number of n hex digits: 16^(n-1) and what is drawn below 15 * 16^(n-1)
    least = lambda n: F.shiftleft(F.lit(1).cast("bigint"), 4 * (n - 1)) if isinstance(n, int) else F.pow(F.lit(16.0), n - 1).cast("bigint")
    group = lambda n, i: F.lower(F.hex(least(n) + F.pmod(h(i), 15 * least(n))))
    six = F.array_join(F.transform(F.split(entity, ":"), lambda g, i: F.when(g == "0", g).otherwise(group(F.when(attempt >= WIDER, 4).otherwise(F.length(g)), i))), ":")
    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: group(4, i)), ":")
    return F.when(attempt >= LAST, whole).when(F.contains(entity, F.lit(":")), six).otherwise(four)


def _syllables(script: str, h, n: Column) -> Column:
    """n syllables."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: _pick(SYLLABLES[script], h(i))), "")


def _family(key: str, entity: Column, attempt: Column) -> Column:
    h = lambda i: _hashed(key, F.lit("family"), entity, attempt, i)
    made = lambda s: F.initcap(_syllables(s, h, 3 + attempt))
    return F.when(_script(entity) == "C", made("C")).when(_script(entity) == "G", made("G")).otherwise(made("L"))


def _given(key: str, entity: Column, attempt: Column, gender: Column) -> Column:
    """A known name of the gender and script; from the third attempt on one of syllables with an ending of the gender."""
    h = lambda i: _hashed(key, F.concat(F.lit("given"), gender), entity, attempt, i)
    sex = F.when(gender == "x", F.when(F.pmod(h(F.lit(-1)), F.lit(2)) == 0, "m").otherwise("f")).otherwise(gender)
    out = None
    for s in "CGL":
        for g in "mf":
            made = F.when(attempt < 2, _pick(GIVEN[g + s], h(F.lit(0)))).otherwise(F.initcap(F.concat(_syllables(s, h, attempt), _pick(ENDINGS[g + s], h(F.lit(0))))))
            own = (_script(entity) == s) & (sex == g)
            out = F.when(own, made) if out is None else out.when(own, made)
    return out


def drawn(key: str, rows: DataFrame) -> DataFrame:
    """rows (kind, entity, gender, attempt) with made, the surrogate in the form of the entity's identity; names begin with a capital."""
    kind, entity, attempt, gender = (F.col(c) for c in ("kind", "entity", "attempt", "gender"))
    long = F.when(kind == "email", F.concat(_more(attempt, "a"), entity)).otherwise(F.concat(entity, _more(attempt, "0")))
    letters = F.when(~kind.isin("ip", "family", "given"), _letters(key, kind, long, attempt))
    own = F.col("__letters")
    top, code = F.regexp_extract(entity, r"\.[^.@]*$", 0), F.regexp_extract(entity, CALLING, 0)
    made = (
        F.when(kind == "ip", _ip(key, entity, attempt)).when(kind == "card", _card(entity, own)).when(kind == "iban", _iban(entity, own))
        .when(kind == "family", _family(key, entity, attempt)).when(kind == "given", _given(key, entity, attempt, gender))
        .when(kind == "email", F.concat(F.left(own, F.length(own) - F.length(top)), top)).when(kind == "phone", F.concat(code, F.substr(own, F.length(code) + 1))).otherwise(own)
    )
    return rows.withColumn("__letters", letters).withColumn("made", made).drop("__letters")


def _spread(value: Column, made: Column) -> Column:
    """made with the separators of value, and in small letters where value is. Mentions that have separators are of bounded length."""
    plain = F.length(F.regexp_replace(value, r"[\s().-]", ""))
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))
    separator = lambda c: F.regexp_like(c, F.lit(r"[\s().-]"))
    spread = F.aggregate(_signs(value), start, lambda a, c: F.struct((a["n"] + F.when(separator(c), 0).otherwise(1)).alias("n"), F.concat(a["out"], F.when(separator(c), c).otherwise(F.substr(made, a["n"] + 1, F.lit(1)))).alias("out")))["out"]
    spread = F.concat(spread, F.substr(made, plain + 1))
    return F.when(F.regexp_like(value, F.lit("[a-z]")), F.lower(spread)).otherwise(spread)


def _signs(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _cased(value: Column, made: Column) -> Column:
    """made with capitals where value has some, counted from the end, as surrogates grow at the front."""
    pairs = F.zip_with(F.reverse(_signs(made)), F.reverse(_signs(value)), lambda m, v: F.when(v != F.lower(v), F.upper(m)).otherwise(m))
    return F.array_join(F.reverse(F.slice(pairs, F.lit(1), F.length(made))), "")


def _ip_formed(value: Column, made: Column) -> Column:
    """An IPv6 surrogate as the mention is written: short where that is, with its leading zeros and case. Others as they are."""
    parts, groups = F.split(value, ":"), F.split(made, ":")
    empty = F.array_position(parts, "")
    group = lambda i: F.when((empty == 0) | (i < empty - 1), F.get(groups, i)).otherwise(F.get(groups, F.size(groups) - (F.size(parts) - i)))
    padded = lambda p, g: F.when(F.length(g) < F.length(p), F.concat(F.repeat(F.lit("0"), F.length(p) - F.length(g)), g)).otherwise(g)
    short = F.array_join(F.transform(parts, lambda p, i: F.when(p == "", "").otherwise(padded(p, group(i)))), ":")
    six = F.when((empty > 0) & (F.length(made) == 39), made).otherwise(short)
    six = F.when(F.regexp_like(value, F.lit("[A-F]")), F.upper(six)).otherwise(six)
    return F.when(F.contains(value, F.lit(":")), six).otherwise(made)


def _formed(kind: Column, value: Column, made: Column) -> Column:
    """The surrogate in the form of a mention (of a name: of a word of one)."""
    kept = F.regexp_extract(value, r"^(?:\p{L}['’]|Mc(?=\p{Lu})|Mac(?=\p{Lu}))", 0)
    name = F.when((value == F.upper(value)) & (F.length(value) > 1), F.concat(kept, F.upper(made))).otherwise(F.concat(kept, made))
    return F.when(kind == "email", _cased(value, made)).when(kind == "ip", _ip_formed(value, made)).when(kind.isin("family", "given"), name).otherwise(_spread(value, made))


def _word(value: Column) -> Column:
    """The identity of a word of a name."""
    return F.replace(F.lower(value), F.lit("’"), F.lit("'"))


def _ip_entity(value: Column) -> Column:
    """All groups of an IPv6 address, without leading zeros; IPv4 as it is."""
    side = lambda i: F.filter(F.split(F.element_at(F.split(F.lower(value), "::"), i), ":"), lambda g: g != "")
    left, right = side(1), side(-1)
    short = F.concat(left, F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right)), right)
    groups = F.when(F.contains(value, F.lit("::")), short).otherwise(F.split(F.lower(value), ":"))
    six = F.array_join(F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")
    return F.when(F.contains(value, F.lit(":")), six).otherwise(value)


def _parted(hits: DataFrame) -> DataFrame:
    """hits (digest, at, value, kind) to mentions: digest, at, part (0 for the first), before (what stands before it in the hit), value, main_kind, entity and gender.

    Of a name, each word is a mention; those of the last word (and what hyphens join to it) are of the family name.
    """
    kind, value = F.col("kind"), F.col("value")
    title = F.regexp_extract(value, f"^(?:{TITLE}) ", 0)
    body = F.substr(value, F.length(title) + 1)
    words, gaps = F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), F.split(body, WORD)
    last = F.size(F.regexp_extract_all(F.element_at(F.split(body, " "), -1), F.lit(WORD), F.lit(0)))
    first = _word(F.get(words, F.lit(0)))
    known = {g: F.array(*(F.lit(n.lower()) for k, names in GIVEN.items() if k[0] == g for n in names)) for g in "mf"}
    gender = F.when(F.regexp_like(title, F.lit(f"^(?:{MALE}) $")), "m").when(F.regexp_like(title, F.lit(f"^(?:{FEMALE}) $")), "f")
    gender = gender.when(F.array_contains(known["m"], first), "m").when(F.array_contains(known["f"], first), "f").otherwise("x")
    part = lambda w, i: F.struct(
        i.alias("part"), F.when(i == 0, F.concat(title, F.get(gaps, i))).otherwise(F.get(gaps, i)).alias("before"), w.alias("value"),
        F.when(i >= F.size(words) - last, "family").otherwise("given").alias("main_kind"), _word(w).alias("entity"), F.when(i >= F.size(words) - last, "x").otherwise(gender).alias("gender"),
    )
    plain = F.regexp_replace(F.upper(value), r"[\s().-]", "")
    entity = F.when(kind == "email", F.lower(value)).when(kind == "ip", _ip_entity(value)).otherwise(plain)
    whole = F.struct(F.lit(0).alias("part"), F.lit("").alias("before"), value.alias("value"), kind.alias("main_kind"), entity.alias("entity"), F.lit("x").alias("gender"))
    return hits.select("digest", "at", "kind", F.inline(F.when(kind == "name", F.transform(words, part)).otherwise(F.array(whole))))


def surrogates(key: str, mentions: DataFrame) -> DataFrame:
    """main_kind, entity, gender and made, for the distinct entities of mentions; all made of a kind are distinct, and none is an entity of it."""
    own = settled(mentions.select(F.col("main_kind").alias("kind"), "entity", "gender").distinct().withColumn("attempt", F.lit(0)), "op8-entities")
    taken = own.select("kind", F.col("entity").alias("id")).distinct().withColumn("real", F.lit(True))

    identity = F.when(F.col("kind").isin("family", "given"), F.lower("made")).otherwise(F.col("made"))
    done = settled(drawn(key, own), "op8-made")
    while True:
        first = done.withColumn("id", identity).groupBy("kind", "id").agg(F.min(F.struct("entity", "gender")).alias("least"), F.count("*").alias("n"))
        clash = first.join(taken, ["kind", "id"], "left").where("n > 1 or real")
        again = done.withColumn("id", identity).join(clash.select("kind", "id", "least", "real"), ["kind", "id"]).where(F.col("real") | (F.struct("entity", "gender") != F.col("least")))
        again = settled(again.select("kind", "entity", "gender", F.lit(1).alias("more")), "op8-again")
        if again.isEmpty():
            dropped(own, again)
            return done.select(F.col("kind").alias("main_kind"), "entity", "gender", "made")
        old, marked = done, done.join(again, ["kind", "entity", "gender"], "left")
        moved = drawn(key, marked.where("more = 1").select("kind", "entity", "gender", (F.col("attempt") + 1).alias("attempt")))
        done = settled(marked.where("more is null").select("kind", "entity", "gender", "attempt", "made").unionByName(moved.select("kind", "entity", "gender", "attempt", "made")), "op8-made")
        dropped(old, again)


def replaced(docs: DataFrame, *, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text with surrogates, n_entities and kinds (how many of each of KINDS)."""
    t = F.col("text")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("hits", F.when(F.regexp_like(t, F.lit(MAY)), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("hits", F.coalesce("hits", F.array().cast("array<string>")))
    rows = settled(rows.withColumn("digest", F.when(F.size("hits") > 0, F.sha2("text", 256))), "op8-rows")
    none = F.array(*(F.lit(0) for _ in KINDS))
    clean = rows.where("digest is null").select("doc_id", "text", F.lit(0).alias("n_entities"), none.alias("kinds"))
    some = rows.where("digest is not null")
    # one row for each text; where it has names, all words that may be parts of them are hits as well
    some = some.withColumn("named", F.exists("hits", lambda h: kind_of(h) == "name"))
    once = some.select("digest", "text", "hits", "named").dropDuplicates(["digest"])
    once = once.withColumn("hits", F.when(F.col("named"), F.regexp_extract_all("text", F.lit(ANY_WORD), F.lit(0))).otherwise(F.col("hits")))
    hits = once.select("digest", F.posexplode("hits").alias("at", "value")).withColumn("kind", kind_of(F.col("value")))
    hits = settled(hits, "op8-hits")
    own = settled(_parted(hits.where("kind <> 'word'")), "op8-mentions")
    roles = own.where("kind = 'name'").groupBy("digest", "entity").agg(F.min(F.struct("main_kind", "gender")).alias("role"))
    words = hits.where("kind = 'word'").withColumn("entity", _word(F.col("value"))).join(roles, ["digest", "entity"], "left")
    words = settled(words.select("digest", "at", "value", "entity", F.col("role.main_kind").alias("main_kind"), F.col("role.gender").alias("gender")), "op8-words")
    mentions = own.unionByName(words.where("main_kind is not null").select("digest", "at", F.lit("name").alias("kind"), F.lit(0).alias("part"), F.lit("").alias("before"), "value", "main_kind", "entity", "gender"))
    new = mentions.join(surrogates(key, own), ["main_kind", "entity", "gender"])
    new = new.select("digest", "at", "part", "kind", F.concat("before", _formed(F.col("main_kind"), F.col("value"), F.col("made"))).alias("new"))
    same = words.where("main_kind is null").select("digest", "at", F.lit(0).alias("part"), F.lit(None).cast("string").alias("kind"), F.col("value").alias("new"))
    by_text = new.unionAll(same).groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("at", "part", "kind", "new"))).alias("new"))
    gaps = F.when(F.col("named"), F.split("text", ANY_WORD, -1)).otherwise(F.split("text", ANY, -1))
    pieces = F.transform("new", lambda x: F.concat(F.when(x["part"] == 0, F.get(F.col("gaps"), x["at"])).otherwise(""), x["new"]))
    text_out = F.concat(F.array_join(pieces, ""), F.element_at("gaps", -1))
    count = lambda wanted: F.size(F.filter("new", lambda x: (x["part"] == 0) & (x["kind"] == wanted)))
    kinds = F.array(*(count(F.lit(wanted)) for wanted in KINDS))
    changed = some.join(by_text, "digest").withColumn("gaps", gaps).select("doc_id", text_out.alias("text"), F.size(F.filter("new", lambda x: (x["part"] == 0) & x["kind"].isNotNull())).alias("n_entities"), kinds.alias("kinds"))
    return clean.unionAll(changed)


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data, by the key in spark.tideline.pii.key (a public one where that is unset)."""
    out = replaced(table(spark, sf_dir, "documents"), key=spark.conf.get("spark.tideline.pii.key", "tideline"))
    return out.select("doc_id", "text", F.col("n_entities").cast("bigint").alias("n_entities"), *(F.element_at("kinds", i + 1).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)))
