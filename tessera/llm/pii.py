"""Personal data and secrets are replaced by keyed surrogates.

One pattern finds the entities. Each has a core that its spellings share (the
digits of a phone or card number, a lower-cased address, a part of a name), and
the core's surrogate comes from SHA-256 over a secret key, the kind and the core.
So one person or number gets one surrogate everywhere, in every document and run
with that key, and nobody without the key can link the two. The surrogate is of
the same type and format: digits for digits, letters for letters in the same
case, separators, country code, card network and check digit, domain ending and
key prefix as before, address octets in range. Card numbers are taken only with a right Luhn sum
and account numbers only with right check digits, and their surrogates have right ones.
Names that follow a title get names, part by part, of the same gender (by the title; family
names by their ending where the script has gendered ones) and the same script; further
mentions of a part within its text are replaced alike, with or without a title.

Collision checks keep distinct entities distinct: over the cores of all documents,
a surrogate that two cores share, or that is itself a core of the corpus, is
drawn anew with the next attempt number for all but the smallest core, round by
round until none is left. The cores are distinct on the map side first, so a
frequent one counts once a task. Attempt 0 needs no table and is computed in the
row; only texts that hold a core with a later attempt are joined (by the text's
digest) with its surrogates.

Only DataFrame functions are used, also between the steps. Repeats in entity
patterns are bounded or possessive, which the regex engine runs without its stack:
secrets and keys of any length are found whole.

Defined results: null texts stay null and empty ones empty; texts without
entities are returned unchanged; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, stored, without

# Titles by gender; fixed values.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Don", "Sr", "Господин", "Κύριος")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Lady", "Frau", "Fräulein", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Doña", "Sra", "Госпожа", "Κυρία")
# They do not show a gender; a given name that ends in a is taken to be a woman's.
NEUTRAL_TITLES = ("Dr", "Prof", "Professor", "Доктор", "Mag", "Пан")

_WORD_BEFORE = r"(?<![\p{L}\p{N}_])"
ALL_TITLES = MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES
_TITLES = "|".join(sorted(ALL_TITLES, key=len, reverse=True))
# Small words inside names; they stay.
PARTICLES = "de del della di da das do dos du des la las le los van von vom der den ter ten und zu af av bin ben ibn al el y e".split()
_PARTICLE = rf"(?:{'|'.join(PARTICLES)})"
_WORD_ENDS = r"(?![\p{L}\p{M}])"
_INITIALS = r"(?:\p{Lu}(?:\. ?| ))*+"
# Words that follow a name and a hyphen without being part of it.
_AFTER_HYPHEN = "led|style|like|based|owned|backed|run|era"
_NAME_PART = (
    rf"(?!(?:{_TITLES}){_WORD_ENDS})(?:\p{{L}}['’](?=\p{{Lu}}))?\p{{Lu}}[\p{{L}}\p{{M}}]++"
    rf"(?:['’](?=\p{{Lu}}|\p{{Ll}}{{3}})[\p{{L}}\p{{M}}]++|-(?=\p{{L}}{{2}})(?!(?:{_AFTER_HYPHEN}){_WORD_ENDS})[\p{{L}}\p{{M}}]++)*+(?![\p{{N}}_])"
)
_NAME = rf"(?:{_PARTICLE} )*+{_INITIALS}{_NAME_PART}"
# A part of a name with a surrogate of its own: not a particle, nor the O of O'Brien.
NAME_UNIT = rf"(?<![\p{{L}}\p{{M}}])(?!{_PARTICLE}{_WORD_ENDS}|\p{{L}}['’])[\p{{L}}\p{{M}}]++"
# What a secret consists of: anything up to white space or a quote, but not the punctuation at its end.
_SECRET_END = r".,;:!?)\]}>"
_SECRET = rf"[^\s\"'{_SECRET_END}]"
_SECRET_INNER = rf"[{_SECRET_END}](?=[{_SECRET_END}]*+{_SECRET})"
# Between digits of an international number: one separator, and brackets around a group.
_BLANK = r" \x{a0}\x{202f}"
_PHONE_GAP = rf"(?:[{_BLANK}./-]?\(|\)[{_BLANK}./-]?|[{_BLANK}./-])?"
# (kind, pattern), in the order in which they are tried at a place.
PATTERNS = (
    ("secret", r"(?<![A-Za-z0-9])(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?(?=[^\s\"'0-9]*+[0-9])"
        rf"(?=(?:{_SECRET}|{_SECRET_INNER}){{8}})(?:{_SECRET}++|[{_SECRET_END}]++(?={_SECRET}))++"),
    # A label is part of the domain if a letter comes after it and further digits, dots and hyphens.
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:(?:[A-Za-z0-9-]++\.(?=[0-9.-]*+[A-Za-z]))++[A-Za-z]{2,}+|(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})"),
    ("key", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\w|\.[0-9])"),
    ("phone", rf"(?<![\w+])\+1(?:{_PHONE_GAP}[0-9]){{10}}(?![0-9])"),
    ("phone", rf"(?<![\w+])\+[0-9](?:{_PHONE_GAP}[0-9]){{6,14}}(?![0-9])"),
    ("phone", r"(?<![\w)+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    ("ssn", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    # National numbers: German, French, Spanish.
    ("phone", r"(?<![\w.,/+-])(?=0[0-9 /-]{8,17}(?![0-9]))0[1-9][0-9]{1,4}[ /-][0-9]{2,9}+(?:[ -][0-9]{2,9}+){0,3}+(?![\w-])"),
    ("phone", r"(?<![\w.,/+-])0[1-9](?:[ .-][0-9]{2}){4}(?![\w-])"),
    ("phone", r"(?<![\w.,/+-])[6789][0-9]{2}(?:[ .-][0-9]{2}){3}(?![\w-])"),
    ("card", r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])"),
    ("name", _WORD_BEFORE + rf"(?:{_TITLES})\.? {_NAME}(?: {_NAME})*+"),
)
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
# A text without any of these holds no entity.
HINT = "[0-9@]"
HINT_WORDS = ("AKIA", "ghp_", "sk-", *ALL_TITLES)
# What has the form of an entity but fails its check sum stays as it is.
PLAIN = "plain"

# Syllables of surrogate names by script, and endings by script and gender; fixed values.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ja ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зе ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то".split(),
    "greek": "βα βε βο γα γε δα δε δο ζα θα θε κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το φα".split(),
}
GIVEN_ENDINGS = {
    "latin": {"m": "rd n ld s".split(), "f": "na lia ra ia".split()},
    "cyrillic": {"m": "н р слав мир".split(), "f": "на ра лия ина".split()},
    "greek": {"m": "ς ας ος ης".split(), "f": "α η ια νη".split()},
}
FAMILY_ENDINGS = {
    "latin": {"m": "ner son field mar".split(), "f": "ner son field mar".split()},
    "cyrillic": {"m": "нов рев лин ров".split(), "f": "нова рева лина рова".split()},
    "greek": {"m": "ίδης όπουλος άκης ούδης".split(), "f": "ίδη οπούλου άκη ούδη".split()},
}
# Letters for names in other scripts, which keep their length; fixed values.
SCRIPT_LETTERS = {
    "armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօ",
    "hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ",
    "devanagari": "अआइउएकखगघचछजटठडतथदधनपफबभमयरलवशसह",
    "hangul": "가나다라마바사아자차카타파하고노도로모보소오조코토포호구누두루무부수우주",
    "han": "王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗郑梁谢宋唐许韩冯邓曹",
    "hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ",
    "katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ",
    "thai": "กขคงจชซดตถทนบปผพฟมยรลวสหอ",
}
NAME_SYLLABLES = 4
MAX_ATTEMPTS = 1_000
LONG_CORE = 1_024

UNIT = "struct<kind:string,core:string>"


def _kind(entity: Column) -> Column:
    """The kind of a whole entity: that of the first pattern that fits it."""
    tests = [entity.rlike(rf"\A(?:{p})\z") for _, p in PATTERNS]
    out = F.lit(None).cast("string")
    for (kind, _), test in reversed(list(zip(PATTERNS, tests, strict=True))):
        out = F.when(test, F.lit(kind)).otherwise(out)
    return out


def _checked(kind: Column, entity: Column) -> Column:
    """The kind, or ``PLAIN`` for a card or account number whose check sum is wrong."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    sound = F.when(kind == "card", _luhn_sum(digits, 1) % 10 == 0).when(kind == "iban", _mod_97(F.replace(entity, F.lit(" "), F.lit(""))) == 1)
    return F.when(F.coalesce(sound, F.lit(True)), kind).otherwise(F.lit(PLAIN))


def _mod_97(account: Column) -> Column:
    """The remainder of an account number as its check digits take it: the first four
    characters last, letters as 10 to 35."""
    moved = F.upper(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    values = F.transform(F.split(moved, ""), value)
    return F.aggregate(values, F.lit(0), lambda total, v: (total * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _prefix(kind: Column, entity: Column) -> Column:
    """What stands before the part that is replaced: a secret's label, a key's
    prefix, a name's title."""
    return (
        F.when(kind == "secret", F.regexp_extract(entity, r"\A[A-Za-z_-]+\s{0,3}[=:]\s{0,3}[\"']?", 0))
        .when(kind == "key", F.regexp_extract(entity, r"\A(?:AKIA|ghp_|sk-(?:proj-)?)", 0))
        .when(kind == "name", F.regexp_extract(entity, r"\A\p{L}+\.? ", 0))
        .otherwise(F.lit(""))
    )


def _is_digits(kind: Column) -> Column:
    return kind.isin("phone", "ssn", "card")


def described(found: Column) -> Column:
    """Each entity with its kind, the part before what is replaced, and that.
    Every step binds its result in a transform, so no expression repeats."""
    kinds = F.transform(found, lambda e: F.struct(e.alias("entity"), _kind(e).alias("kind")))
    kinds = F.transform(kinds, lambda x: F.struct(x["entity"].alias("entity"), _checked(x["kind"], x["entity"]).alias("kind")))
    prefixed = F.transform(
        kinds, lambda x: F.struct(x["entity"].alias("entity"), x["kind"].alias("kind"), _prefix(x["kind"], x["entity"]).alias("prefix"))
    )
    return F.transform(
        prefixed,
        lambda x: F.struct(
            x["kind"].alias("kind"),
            x["prefix"].alias("prefix"),
            F.substring(x["entity"], F.length(x["prefix"]) + 1, F.length(x["entity"])).alias("rest"),
        ),
    )


def units(entity: Column) -> Column:
    """The cores of a described entity, as an array of (kind, core): one, or for
    a name one for each part, with its role, gender and script in the kind."""
    kind, rest = entity["kind"], entity["rest"]
    title = F.rtrim(F.replace(entity["prefix"], F.lit("."), F.lit("")))
    by_name = F.when(rest.rlike(r"\A\p{L}+[aа]\b"), "f").otherwise("m")
    gender = F.when(title.isin(*FEMALE_TITLES), "f").when(title.isin(*NEUTRAL_TITLES), by_name).otherwise("m")

    def part_unit(part: Column, in_family: Column) -> Column:
        script = F.lit("latin")
        for name in ("cyrillic", "greek", *SCRIPT_LETTERS):
            script = F.when(part.rlike(rf"\p{{Is{name.capitalize()}}}"), name).otherwise(script)
        # Only Cyrillic and Greek family names show a gender.
        shown = F.when(script.isin(*SCRIPT_LETTERS) | (in_family & (script == "latin")), "m").otherwise(gender)
        role = F.when(in_family, "family").otherwise("given")
        return F.struct(F.concat_ws(".", role, shown, script).alias("kind"), F.lower(part).alias("core"))

    def parts(of: Column) -> Column:
        return F.regexp_extract_all(of, F.lit(NAME_UNIT), 0)

    # All parts of the last word are the family name.
    last = F.size(parts(F.element_at(F.split(rest, " "), -1)))
    words = F.get(
        F.transform(
            F.array(F.struct(parts(rest).alias("parts"), last.alias("last"))),
            lambda w: F.transform(w["parts"], lambda p, i: part_unit(p, i >= F.size(w["parts"]) - w["last"])),
        ),
        F.lit(0),
    )
    # Only ASCII letters are lowered in secrets, so that the core keeps its length.
    lowered = F.when(kind == "secret", F.translate(rest, LETTERS.upper(), LETTERS)).otherwise(F.lower(rest))
    digits = F.regexp_replace(rest, "[^0-9]", "")
    # A North American number has its country code in the core, also where it is not written.
    american = (kind == "phone") & (F.length(digits) == 10) & ~rest.startswith("+") & ~digits.startswith("0")
    core = (
        F.when(american, F.concat(F.lit("1"), digits))
        .when(_is_digits(kind), digits)
        .when(kind == "iban", F.lower(F.replace(rest, F.lit(" "), F.lit(""))))
        .otherwise(lowered)
    )
    one = F.array(F.struct(kind.alias("kind"), core.alias("core")))
    return F.when(kind == "name", words).when(kind == PLAIN, F.slice(one, 1, 0)).otherwise(one)


def _draws(key: str, unit_kind: Column, core: Column, attempt: Column, n: Column) -> Column:
    """``n`` pseudo-random integers below 65536: four hex digits each of keyed SHA-256 blocks."""
    def block(seed: Column, b: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), unit_kind, seed, attempt.cast("string"), b.cast("string")).cast("binary"), 256)

    def drawn(hexes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(hexes, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))

    # The digest stands for a long core, so that the blocks do not each hash all of it.
    seed = F.when(F.length(core) > LONG_CORE, F.sha2(core.cast("binary"), 256)).otherwise(core)
    blocks = F.flatten(F.transform(F.array(seed), lambda s: F.transform(F.sequence(F.lit(0), F.floor(n / 16).cast("int")), lambda b: block(s, b))))
    return F.slice(F.flatten(F.transform(blocks, drawn)), F.lit(1), F.greatest(n, F.lit(1)))


def _char(source: Column, i: Column) -> Column:
    return F.substring(source, i + 1, F.lit(1))


def _pick(alphabet: str, draw: Column) -> Column:
    return F.substring(F.lit(alphabet), draw % len(alphabet) + 1, F.lit(1))


DIGITS, LETTERS, HEX_LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "abcdef"


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum of a digit string; ``doubled``: the place from the right, modulo 2, that counts twice."""
    n = F.length(digits)
    terms = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.when(
            (n - 1 - i) % 2 == doubled, F.when(_char(digits, i).cast("int") > 4, _char(digits, i).cast("int") * 2 - 9).otherwise(_char(digits, i).cast("int") * 2)
        ).otherwise(_char(digits, i).cast("int")),
    )
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x)


def surrogate_core(key: str, kind: Column, core: Column, attempt: Column) -> Column:
    """The surrogate of a core: the same kind, length and character classes."""
    n = F.greatest(F.length(core), F.lit(NAME_SYLLABLES + 1))
    drawn = F.struct(kind.alias("kind"), core.alias("core"), _draws(key, kind, core, attempt, n).alias("draws"))
    return F.get(F.transform(F.array(drawn), lambda u: _from_draws(u["kind"], u["core"], u["draws"])), F.lit(0))


def _from_draws(kind: Column, core: Column, draws: Column) -> Column:
    n = F.length(core)
    draws_of_core = F.slice(draws, F.lit(1), n)

    def by_class(letters: str) -> Column:
        return F.array_join(
            F.zip_with(
                F.split(core, ""),
                draws_of_core,
                lambda c, r: F.when(c.rlike(r"\p{N}"), _pick(DIGITS, r)).when(c.rlike(r"\p{L}"), _pick(letters, r)).otherwise(c),
            ),
            "",
        )

    plain = by_class(LETTERS)
    like_hex = by_class(HEX_LETTERS)
    ending = F.regexp_extract(core, r"\.[a-z]{2,24}\z", 0)
    email = F.concat(F.substring(plain, F.lit(1), n - F.length(ending)), ending)
    bban, land = F.substring(plain, F.lit(5), n), F.substring(core, 1, 2)
    iban = F.concat(land, F.lpad((F.lit(98) - _mod_97(F.concat(land, F.lit("00"), bban))).cast("string"), 2, "0"), bban)
    octets = F.array_join(F.transform(F.slice(draws, 1, 4), lambda r: (r % 254 + 1).cast("string")), ".")
    # North American numbers keep their country code and begin area and exchange with 2 to 9; others keep two digits.
    american = (n == 11) & core.startswith("1")
    phone = F.array_join(
        F.transform(
            draws_of_core,
            lambda r, i: F.when(american & (i == 0), F.lit("1"))
            .when(american & ((i == 1) | (i == 4)), (r % 8 + 2).cast("string"))
            .when(~american & (i < 2), _char(core, i))
            .otherwise((r % 10).cast("string")),
        ),
        "",
    )
    body = F.concat(F.substring(core, 1, 1), F.substring(F.array_join(F.transform(draws, lambda r: (r % 10).cast("string")), ""), F.lit(2), n - 2))
    check = (F.lit(10) - _luhn_sum(body, 0) % 10) % 10
    valid = _luhn_sum(core, 1) % 10 == 0
    card = F.concat(body, F.when(valid, check).otherwise((check + 1 + F.get(draws, n - 1) % 9) % 10).cast("string"))
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", octets)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ssn", plain)
        .when(kind == "iban", iban)
        .when((kind == "secret") & core.rlike(r"\A[0-9a-f]+\z"), like_hex)
        .when(kind.isin("secret", "key"), plain)
    )
    # Names: the tables are literals, looked up by the script, or by role, gender and script.
    script = F.substring_index(kind, ".", -1)
    syllables = F.element_at(_table({k: F.array(*map(F.lit, v)) for k, v in SYLLABLES.items()}), script)
    endings = F.element_at(
        _table(
            {
                f"{role}.{gender}.{k}": F.array(*map(F.lit, by_gender[gender]))
                for role, by_script in (("given", GIVEN_ENDINGS), ("family", FAMILY_ENDINGS))
                for k, by_gender in by_script.items()
                for gender in "mf"
            }
        ),
        kind,
    )
    chosen = lambda values, draw: F.get(values, draw % F.size(values))
    name = F.concat(*[chosen(syllables, F.get(draws, F.lit(i))) for i in range(NAME_SYLLABLES)], chosen(endings, F.get(draws, F.lit(NAME_SYLLABLES))))
    letters = F.element_at(_table({k: F.lit(v) for k, v in SCRIPT_LETTERS.items()}), script)
    same_length = F.array_join(F.transform(draws_of_core, lambda r: F.substring(letters, r % F.length(letters) + 1, F.lit(1))), "")
    return out.when(script.isin(*SCRIPT_LETTERS), same_length).when(script.isin(*SYLLABLES), name)


def _table(values: dict[str, Column]) -> Column:
    return F.create_map(*[x for key, value in values.items() for x in (F.lit(key), value)])


def written(entity: Column, cores: Column) -> Column:
    """A described entity with its surrogate cores (one, or one a name part) in
    its own format."""
    bound = F.struct(*[entity[c].alias(c) for c in ("kind", "prefix", "rest")], cores.alias("cores"))
    return F.get(F.transform(F.array(bound), lambda x: _written(x["kind"], x["prefix"], x["rest"], x["cores"])), F.lit(0))


def _written(kind: Column, prefix: Column, rest: Column, cores: Column) -> Column:
    core = F.get(cores, F.lit(0))
    places = F.sequence(F.lit(0), F.greatest(F.length(rest), F.lit(1)) - 1)
    before = lambda i: F.length(F.regexp_replace(F.substring(rest, F.lit(1), i), "[^A-Z0-9]", ""))
    # A country code of the core that the text does not write is left out.
    unwritten = F.greatest(F.length(core) - F.length(F.regexp_replace(rest, "[^A-Z0-9]", "")), F.lit(0))
    filled = F.transform(
        places, lambda i: F.when(_char(rest, i).rlike("[A-Z0-9]"), F.upper(_char(core, before(i) + unwritten))).otherwise(_char(rest, i))
    )
    cased = F.zip_with(F.split(rest, ""), F.split(core, ""), lambda r, c: F.when(r.rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    titled = F.transform(name_parts(rest, cores), lambda p: p["to"])
    names = F.array_join(F.zip_with(F.split(rest, NAME_UNIT, -1), titled, lambda g, t: F.concat(g, F.coalesce(t, F.lit("")))), "")
    body = (
        F.when(kind == "name", names)
        .when(kind == "ip", core)
        .when(kind == PLAIN, rest)
        .when(_is_digits(kind) | (kind == "iban"), F.array_join(filled, ""))
        .otherwise(F.array_join(cased, ""))
    )
    return F.concat(prefix, body)


def name_parts(rest: Column, cores: Column) -> Column:
    """(from, to) of each part of a name and its surrogate core: an initial gets an
    initial, capitals get capitals, and letters without case stay as they are."""
    return F.zip_with(
        F.regexp_extract_all(rest, F.lit(NAME_UNIT), 0),
        cores,
        lambda p, c: F.struct(
            p.alias("from"),
            F.when(F.length(p) == 1, F.upper(F.substring(c, 1, 1)))
            .when(p.rlike(r"\A[\p{Lu}\p{M}]+\z"), F.upper(c))
            .otherwise(F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c))))
            .alias("to"),
        ),
    )


def entities(text: Column) -> Column:
    """All entities of a text, in order; none for a null text."""
    none = F.array().cast("array<string>")
    # Most texts are clean: plain searches for the words, and one class of characters, tell them apart.
    hint = text.rlike(HINT)
    for word in HINT_WORDS:
        hint = hint | text.contains(word)
    return F.when(hint, F.regexp_extract_all(text, F.lit(ENTITY), 0)).otherwise(none)


def _rebuilt(text: Column, found: Column, replaced: Column) -> Column:
    """The text with its entities (``replaced``: their text and the parts of names) in
    order, and further mentions of a name's parts between them replaced alike."""
    gaps = F.split(text, ENTITY, -1)
    parts = F.array_distinct(F.filter(F.flatten(F.transform(replaced, lambda e: e["parts"])), lambda p: F.length(p["from"]) > 1))

    def mentioned(gap: Column, known: Column) -> Column:
        whole = lambda p: F.concat(F.lit(r"(?<![\p{L}\p{M}])"), p["from"], F.lit(r"(?![\p{L}\p{M}])"))
        return F.aggregate(known, gap, lambda t, p: F.when(t.contains(p["from"]), F.regexp_replace(t, whole(p), p["to"])).otherwise(t))

    bound = F.struct(gaps.alias("gaps"), parts.alias("parts"), F.transform(replaced, lambda e: e["text"]).alias("texts"))
    whole = F.transform(
        F.array(bound),
        lambda b: F.array_join(F.zip_with(F.transform(b["gaps"], lambda g: mentioned(g, b["parts"])), b["texts"], lambda g, e: F.concat(g, F.coalesce(e, F.lit("")))), ""),
    )
    return F.when(F.size(found) > 0, F.get(whole, F.lit(0))).otherwise(text)


def _replacement(entity: Column, cores: Column) -> Column:
    """An entity's text with its surrogates, and the parts of a name."""
    none = F.array().cast("array<struct<from:string,to:string>>")
    bound = F.struct(entity.alias("entity"), cores.alias("cores"))
    return F.get(
        F.transform(
            F.array(bound),
            lambda b: F.struct(
                written(b["entity"], b["cores"]).alias("text"),
                F.when(b["entity"]["kind"] == "name", name_parts(b["entity"]["rest"], b["cores"])).otherwise(none).alias("parts"),
            ),
        ),
        F.lit(0),
    )


def assign_surrogates(cores: DataFrame, key: str) -> DataFrame:
    """(kind, core, attempt, surrogate) for each distinct core that needs a later
    attempt than 0, so that surrogates are distinct and none is itself a core."""
    cores = cores.select("kind", "core")
    drawn = cores.withColumn("attempt", F.lit(0)).withColumn(
        "surrogate", surrogate_core(key, F.col("kind"), F.col("core"), F.col("attempt"))
    )
    drawn = stored(drawn, "surrogates")
    real = cores.select(F.col("kind"), F.col("core").alias("surrogate"))
    for _ in range(MAX_ATTEMPTS):
        first = drawn.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "core")).alias("first"))
        clashes = first.where("n > 1").select("kind", "surrogate", "first")
        shared = (
            drawn.join(clashes, ["kind", "surrogate"])
            .where(F.struct("attempt", "core") != F.col("first"))
            .select("kind", "core")
        )
        losers = stored(shared.union(drawn.join(real, ["kind", "surrogate"], "left_semi").select("kind", "core")).distinct(), "collisions")
        if losers.isEmpty():
            return drawn.where("attempt > 0")
        again = drawn.join(losers.withColumn("lost", F.lit(True)), ["kind", "core"], "left")
        attempt = F.when(F.col("lost"), F.col("attempt") + 1).otherwise(F.col("attempt"))
        again = again.select("kind", "core", attempt.alias("attempt"), "surrogate", "lost")
        renewed = F.when(F.col("lost"), surrogate_core(key, F.col("kind"), F.col("core"), F.col("attempt"))).otherwise(F.col("surrogate"))
        drawn = stored(again.select("kind", "core", "attempt", renewed.alias("surrogate")), "surrogates")
    raise ValueError(f"surrogates still collide after {MAX_ATTEMPTS} attempts: there are too few of one format")


def replace_pii(docs: DataFrame, text_col: str, key: str, count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``count_col``, if given, gets
    the number of entities replaced, in place of a column of that name."""
    found = fresh(docs, "entities")
    marked = docs.withColumn(found, described(entities(col(text_col))))
    flat = marked.select(F.explode(found).alias("entity")).distinct().select(F.explode(units(F.col("entity"))).alias("u"))
    cores = stored(flat.select("u.kind", "u.core").distinct(), "cores")
    later = stored(assign_surrogates(cores, key), "overrides")

    def drawn(unit: Column) -> Column:
        return surrogate_core(key, unit["kind"], unit["core"], F.lit(0))

    in_row = F.transform(col(found), lambda e: _replacement(e, F.transform(units(e), drawn)))
    if later.isEmpty():
        out = marked.withColumn(text_col, _rebuilt(col(text_col), col(found), in_row))
    else:
        # Texts without entities pass by; the others meet their overrides by the text's digest
        # (equal texts share them, and no row id is needed).
        digest, table = fresh(docs, "digest"), fresh(docs, "overrides")
        keyed = marked.where(F.size(found) > 0).withColumn(digest, F.sha2(col(text_col).cast("binary"), 256))
        pairs = keyed.select(digest, F.explode(found).alias("entity")).distinct()
        wanted = pairs.select(digest, F.explode(units(F.col("entity"))).alias("u")).select(digest, "u.kind", "u.core").distinct()
        per_text = wanted.join(later, ["kind", "core"]).groupBy(digest).agg(
            F.map_from_entries(F.collect_set(F.struct(F.struct("kind", "core"), "surrogate"))).alias(table)
        )
        joined = keyed.join(per_text, digest, "left")
        with_later = F.transform(
            col(found),
            lambda e: _replacement(e, F.transform(units(e), lambda u: F.coalesce(F.try_element_at(F.col(table), u), drawn(u)))),
        )
        replaced = F.when(F.col(table).isNull(), in_row).otherwise(with_later)
        changed = joined.withColumn(text_col, _rebuilt(col(text_col), col(found), replaced)).select(*[col(c) for c in marked.columns])
        out = changed.union(marked.where(F.size(found) == 0))
    if not count_col:
        return out.select(*[col(c) for c in docs.columns])
    number = F.size(F.filter(col(found), lambda e: e["kind"] != PLAIN)).cast("long")
    return out.select(*without(docs, count_col), number.alias(count_col))
