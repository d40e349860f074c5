"""Personal data replaced by surrogates.

Names are found by a form of address, a short list of given names or words such as "my name
is". The given names that such places show anywhere in the corpus are then known in all of
it: two capitalised words of which the first is such a given name are a name as well.

Entities are found in every text, brought to a canonical form, and each distinct one is
given one surrogate of its kind for the whole corpus, so that mentions of one entity still
agree and different entities still differ. Surrogates are drawn from a keyed hash and keep
the format: digits stay digits between the same separators, checksums hold, a domain stays
the same for all its addresses, names keep gender, script and capitals. A draw that
another entity has, or that is itself an entity of the corpus, is drawn again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, staged

#: Forms of address by gender, and given names that show one.
TITLES = {
    "f": (
        "Mrs Ms Miss Madame Mme Mademoiselle Frau Señora Sra Señorita Signora Госпожа "
        "Κυρία "
    ).split(),
    "m": "Mr Mister Monsieur Herr Señor Sr Signor Господин Κύριος".split(),
    "n": "Dr Prof Doctor Professor Dra Доктор".split(),
}
GIVEN = {
    "f": (
        "Mary Anna Maria Sophie Claire Julia Laura Emma Carmen Lucia Elena Ingrid Helga "
        "Анна Мария Ольга Ελένη "
    ).split(),
    "m": (
        "John James Peter Thomas Pierre Jean Hans Karl Jürgen Carlos Juan José Miguel "
        "Paul Иван Пётр Сергей Γιώργος "
    ).split(),
}
#: Syllables and endings from which names of a script are made.
SYLLABLES = {
    "latin": (
        "ba be bo da de do fa fe ga go ka ke la le li lo ma me mi mo na ne no ra re ri ro "
        "sa se so ta te to va ve vi "
    ).split(),
    "cyrillic": (
        "ба бе бо ва ве во га го да де до ка ко ла ле ло ма ми мо на не но ра ре ро са се "
        "со та те то "
    ).split(),
    "greek": (
        "βα βε βο γα γε δα δε κα κο λα λε λο μα με μι μο να νε νο πα πε πο ρα ρο σα σε σο "
        "τα τε το "
    ).split(),
}
ENDINGS = {
    "latin": {"f": "na", "m": "lf", "n": "ny", "surname": "ner"},
    "cyrillic": {"f": "на", "m": "мир", "n": "ли", "surname": "енко"},
    "greek": {"f": "νη", "m": "νος", "n": "νι", "surname": "ίδης"},
}

#: Words behind which two capitalised words are a name.
CUES = (
    "my name is", "i am", "i'm", "this is", "name:", "named", "contact", "contact:", "author:",
    "from:", "to:", "attn:", "regards,", "sincerely,", "signed,", "signed by", "signed:", "dear",
)
_ALL_CUES = "|".join(sorted(map(re.escape, CUES), key=len, reverse=True))
#: Those behind which hardly anything but a person stands: names found there are learned.
SURE_CUES = {
    "my name is", "name:", "author:", "attn:", "regards,", "sincerely,", "signed,", "signed by",
    "signed:",
}

_CAPITAL = "[^\\W\\d_a-zß-öø-ÿа-яёά-ώ]"
_NAME = rf"{_CAPITAL}[^\W\d_]+(?:-{_CAPITAL}[^\W\d_]+)?"
_ALL_TITLES = "|".join(t for titles in TITLES.values() for t in titles)
_ALL_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


#: Kind, pattern, canonical form and test, in order of precedence.
PATTERNS: tuple[tuple[str, re.Pattern, Callable[[str], str], Callable[[str], bool]], ...] = (
    (
        "iban",
        re.compile(
            r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
            r"(?![A-Za-z0-9])"
        ),
        lambda x: x.replace(" ", ""),
        lambda x: 15 <= len(x) <= 34 and _mod97(x) == 1,
    ),
    (
        "card",
        re.compile(r"(?<![0-9A-Za-z.-])[2-6](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"),
        _digits,
        _luhn,
    ),
    (
        "phone",
        re.compile(
            r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
            r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
            r"|(?<![0-9A-Za-z.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
            r"|(?<![0-9A-Za-z.+-])[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9])"
            r"|(?<![0-9A-Za-z.+-])0[0-9]{2,4} [0-9]{3,4} [0-9]{3,4}(?![0-9])"
        ),
        lambda x: ("+" if x[0] == "+" else "") + _digits(x),
        lambda x: 7 <= len(x.lstrip("+")) <= 15,
    ),
    (
        "ssn",
        re.compile(r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"),
        _digits,
        lambda x: True,
    ),
    (
        "ip",
        re.compile(rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"),
        str,
        lambda x: True,
    ),
)
#: A second name; a form of address behind a name begins the next one.
_LAST_NAME = rf"(?!(?:{_ALL_TITLES})\.?[ ]){_NAME}"
PERSON = re.compile(
    rf"(?<!\w)(?:(?P<title>{_ALL_TITLES})\.?[ ](?P<named>{_NAME}(?:[ ]{_LAST_NAME})?)"
    rf"|(?P<given>{_ALL_GIVEN})[ ](?P<surname>{_LAST_NAME})"
    rf"|(?i:{_ALL_CUES})[ \n](?P<cued>{_NAME}[ ]{_LAST_NAME})(?!\w))"
)
#: Two or three capitalised words that may be a name; the next may begin with the second.
PAIR = re.compile(rf"(?<![\w-])({_NAME}) (?=({_NAME})(?: ({_NAME}))?(?![\w-]))")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
#: An address is looked for from its ``@``: the part before it has this many characters at
#: most, as the standard says, so that a long run of letters costs nothing.
LOCAL_PART = 64
_LOCAL = re.compile(r"[\w.%+-]*[\w%+-]\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
#: A test that every text with an entity passes, for an engine whose time does not depend
#: on the number of alternatives.
MAYBE = (
    r"@|[0-9][0-9() .-]{5,}[0-9]|[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"
    rf"|(?:{_ALL_TITLES}|{_ALL_GIVEN})\.? |(?i:{_ALL_CUES})[ \n]"
)
#: The same for texts that may have a ``PAIR``.
MAYBE_PAIR = r"\p{Lu}\p{L}+ \p{Lu}\p{L}"

_TITLES = {t for titles in TITLES.values() for t in titles}
_GENDER_OF = {n.lower(): g for g, names in (*TITLES.items(), *GIVEN.items()) for n in names}


def _script(name: str) -> str:
    code = ord(name[0])
    return "cyrillic" if 0x400 <= code < 0x530 else "greek" if 0x370 <= code < 0x400 else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` of the entities, without overlaps, by place.

    Addresses take precedence over ``PATTERNS``, earlier kinds of these over later ones and
    over names. The parts of a name are entities of their own, ``given_f``, ``given_m``,
    ``given_n`` and ``surname``; a name's parts are also found where they stand alone.
    """
    return _read(text)[0]


def _read(text: str) -> tuple[list[tuple[int, int, str, str]], set[tuple[str, str]]]:
    """``find``'s entities, and the given names to learn, each behind its gender."""
    learned: set[tuple[str, str]] = set()
    found: list[tuple[int, int, str, str]] = []
    taken: set[int] = set()

    def add(start: int, end: int, kind: str, canonical: str) -> None:
        if taken.isdisjoint(range(start, end)):
            taken.update(range(start, end))
            found.append((start, end, kind, canonical))

    last = 0
    at = text.find("@")
    while at >= 0:
        local = _LOCAL.search(text[max(last, at - LOCAL_PART) : at])
        domain = local and _DOMAIN.match(text, at + 1)
        if domain:
            start, last = at - len(local[0]), domain.end()
            add(start, last, "email", text[start:last].lower())
        at = text.find("@", at + 1)
    for kind, pattern, canonical, valid in PATTERNS:
        for match in pattern.finditer(text):
            value = canonical(match[0])
            if valid(value):
                add(match.start(), match.end(), kind, value)
    names: dict[str, str] = {}
    for match in PERSON.finditer(text):
        if match["cued"]:
            gender, parts, at = "n", match["cued"].split(" "), match.start("cued")
            sure = text[match.start() : at - 1].lower() in SURE_CUES
        elif match["title"]:
            gender = _GENDER_OF[match["title"].lower()]
            parts = match["named"].split(" ")
            at, sure = match.start("named"), len(parts) == 2
        else:
            gender, at = _GENDER_OF[match["given"].lower()], match.start("given")
            parts, sure = [match["given"], match["surname"]], False
        if sure:
            learned.add((_GENDER_OF.get(parts[0].lower(), gender), parts[0].lower()))
        for k, part in enumerate(parts):
            last = k == len(parts) - 1
            own = _GENDER_OF.get(part.lower(), gender)
            kind = "surname" if last else f"given_{own}"
            add(at, at + len(part), kind, part.lower())
            names.setdefault(part, kind)
            at += len(part) + 1
    if names:
        for match in WORD.finditer(text):
            if match[0] in names:
                add(match.start(), match.end(), names[match[0]], match[0].lower())
    return sorted(found), learned


def pairs(text: str) -> set[str]:
    """The distinct pairs of words that may be a name, each as written and in small letters.
    Of three words the first makes a pair with either of the others, forms of address apart."""
    return {
        f"{m[1]} {last} {m[1].lower()} {last.lower()}"
        for m in PAIR.finditer(text)
        for last in m.group(2, 3)
        if last and last not in _TITLES and m[1][0].isupper() and last[0].isupper()
    }


def _bare(text: str, taken: list[tuple[int, int]], names: set[str]) -> list[tuple[int, int, str]]:
    """``start, end, name`` of the names' mentions outside the sorted spans ``taken``."""
    spans, at = [], 0
    for match in WORD.finditer(text):
        if match[0] in names:
            while at < len(taken) and taken[at][1] <= match.start():
                at += 1
            if at == len(taken) or match.end() <= taken[at][0]:
                spans.append((match.start(), match.end(), match[0]))
    return spans


class _Draw:
    """Keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *told: str):
        self._state = hashlib.blake2b("\0".join(told).encode(), key=key, digest_size=64).digest()
        self._left = int.from_bytes(self._state, "big")

    def below(self, n: int) -> int:
        if self._left < 1 << 64:
            self._state = hashlib.blake2b(self._state, digest_size=64).digest()
            self._left = int.from_bytes(self._state, "big")
        self._left, value = divmod(self._left, n)
        return value

    def tag(self) -> str:
        return self._state[:16].hex()

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits."""
        return "".join(
            str(self.below(10)) if c.isdigit() else chr(97 + self.below(26)) if c.isalpha() else c
            for c in text
        )


#: Attempts after which a kind draws from a wider space, and after which an entity gets a
#: tag instead, which keeps neither format nor script, but ends the search.
WIDER, LAST = 4, 24


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical form of an entity's replacement in the given attempt."""
    draw = _Draw(key, kind, canonical, str(attempt))
    if kind == "email":
        # The domain is an entity of its own (see ``surrogates``).
        local, domain = canonical.rsplit("@", 1)
        return f"{draw.like(local + 'a' * (attempt // WIDER))}@{domain}"
    if kind == "domain":
        # The last label stays.
        *labels, last = canonical.split(".")
        labels = [*labels[:-1], "".join([*labels[-1:], "a" * (attempt // WIDER)])]
        return ".".join([*(draw.like(x) for x in labels if x), last])
    if kind == "card":
        body = canonical[0] + draw.like(canonical[1:-1])
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind == "phone":
        plus = canonical.startswith("+")
        kept = canonical[: 2 if plus else 0]
        return kept + draw.like(canonical[len(kept) :])
    if kind == "ssn":
        area = 1 + draw.below(898)
        return f"{area + (area >= 666):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "ip":
        octets = canonical.split(".")
        kept = 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] else 0
        # Where such addresses run short, others of the private range 10 and then any.
        if kept and attempt >= WIDER:
            octets, kept = ["10", *octets[1:]], int(attempt < 2 * WIDER)
        return ".".join([*octets[:kept], *(str(1 + draw.below(254)) for _ in octets[kept:])])
    if kind == "iban":
        body = draw.like(canonical[4:].lower()).upper()
        return f"{canonical[:2]}{98 - _mod97(canonical[:2] + '00' + body):02d}{body}"
    script, role = _script(canonical), kind.rpartition("_")[2]
    syllables = SYLLABLES[script]
    size = 2 + attempt // 4 + (role == "surname")
    stem = "".join(syllables[draw.below(len(syllables))] for _ in range(size))
    return stem + ENDINGS[script][role]


def render(kind: str, mention: str, value: str) -> str:
    """The surrogate in the mention's own format: separators and capitals. A tag stays."""
    if value.startswith("["):
        return value
    if kind in ("card", "phone", "ssn", "iban"):
        fresh = iter(value.lstrip("+"))
        return "".join(next(fresh) if c.isalnum() else c for c in mention)
    if kind == "email":
        if len(value) == len(mention):
            return "".join(v.upper() if c.isupper() else v for c, v in zip(mention, value))
        return value
    if kind == "ip":
        return value
    return value.upper() if mention.isupper() and len(mention) > 1 else value.title()


def _matches(texts: pa.Array, pattern: str) -> np.ndarray:
    found = pc.fill_null(pc.match_substring_regex(texts, pattern), False)
    return found.to_numpy(zero_copy_only=False)


def _maybe(texts: pa.Array) -> np.ndarray:
    return _matches(texts, MAYBE)


def _flagged(rows: DataFrame) -> DataFrame:
    """The rows and whether their text passes ``MAYBE`` or ``MAYBE_PAIR``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            yield batch.append_column("maybe", pa.array(_maybe(texts) | _matches(texts, MAYBE_PAIR)))

    return rows.mapInArrow(run, "doc_id long, text string, text_hash long, maybe boolean")


MENTIONS = "doc_id long, text_hash long, start int, end int, kind string, canonical string"
#: Kinds of rows that are no mentions: a pair that may be a name, and given names to learn.
MAYBE_NAME, LEARNED = "pair", "learned_"


def mentions(rows: DataFrame) -> DataFrame:
    """``MENTIONS`` of rows with ``doc_id, text_hash, text``; rows of the kinds ``MAYBE_NAME``
    and ``LEARNED`` (with a gender) besides, at no place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            out: list[list] = [[] for _ in range(5)]
            flags = np.stack([_matches(batch.column("text"), p) for p in (MAYBE, MAYBE_PAIR)])
            rows = np.flatnonzero(flags.any(axis=0))
            for row, text in zip(rows.tolist(), batch.column("text").take(rows).to_pylist()):
                found, learned = _read(text) if flags[0, row] else ((), ())
                told = [*found, *((None, None, LEARNED + g, name) for g, name in sorted(learned))]
                if flags[1, row]:
                    told += [(None, None, MAYBE_NAME, pair) for pair in sorted(pairs(text))]
                for one in told:
                    for cell, value in zip(out, (row, *one)):
                        cell.append(value)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("text_hash").take(at),
                    pa.array(out[1], pa.int32()),
                    pa.array(out[2], pa.int32()),
                    pa.array(out[3], pa.string()),
                    pa.array(out[4], pa.string()),
                ],
                ["doc_id", "text_hash", "start", "end", "kind", "canonical"],
            )

    return rows.mapInArrow(run, MENTIONS)


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                surrogate(key, *told) if told[2] < LAST else f"[{told[0]} {_Draw(key, *told[:2]).tag()}]"
                for told in zip(*(batch.column(c).to_pylist() for c in ("kind", "canonical", "attempt")))
            ]
            yield batch.append_column("surrogate", pa.array(values, pa.string()))

    return entities.select("kind", "canonical", "attempt").mapInArrow(
        run, "kind string, canonical string, attempt int, surrogate string"
    )


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct entities ``kind, canonical``.

    Of the entities that draw the same surrogate the one with the smallest canonical form
    keeps it, unless it is an entity itself or an earlier round gave it away; the others
    draw again. A round leaves only the colliding ones, later rounds draw from wider spaces,
    and whatever is left after ``LAST`` rounds gets a tag made of its 128-bit hash. Domains
    of addresses are entities of their own, settled first: different domains stay
    different, and all addresses of one move together.
    """
    entities = staged(entities, "entities")
    domains = entities.where("kind = 'email'").select(
        F.lit("domain").alias("kind"), F.substring_index("canonical", "@", -1).alias("canonical")
    )
    moved = staged(_settled(domains.distinct(), key), "domains").select(
        F.col("canonical").alias("domain"), F.col("surrogate").alias("moved")
    )
    return _settled(entities, key, moved)


def _settled(entities: DataFrame, key: bytes, domains: DataFrame | None = None) -> DataFrame:
    """Rounds of draws until every entity has a surrogate; the ``domains`` of addresses are
    replaced as these say."""
    taken = entities.select("kind", F.col("canonical").alias("surrogate"))
    pending = entities.withColumn("attempt", F.lit(0))
    done = None
    while True:
        in_order = Window.partitionBy("kind", "surrogate").orderBy("canonical")
        fresh = _drawn(pending, key)
        if domains is not None:
            fresh = _with_domains(fresh, domains)
        drawn = staged(
            fresh.withColumn("place", F.row_number().over(in_order))
            .join(taken.withColumn("known", F.lit(True)), ["kind", "surrogate"], "left")
            .withColumn("fits", (F.col("place") == 1) & F.col("known").isNull()),
            "surrogates",
        )
        settled = drawn.where("fits").select("kind", "canonical", "surrogate")
        done = settled if done is None else done.unionByName(settled)
        pending = drawn.where("not fits").select(
            "kind", "canonical", (F.col("attempt") + 1).alias("attempt")
        )
        if pending.isEmpty():
            return done
        taken = taken.unionByName(settled.select("kind", "surrogate"))


def _with_domains(drawn: DataFrame, domains: DataFrame) -> DataFrame:
    """The same with addresses at the surrogates of their domains."""
    own = F.when(F.col("kind") == "email", F.substring_index("canonical", "@", -1))
    address = drawn.where("kind = 'email'").withColumn("domain", own).join(domains, "domain")
    local = F.substring_index("surrogate", "@", 1)
    tagged = F.startswith(F.col("surrogate"), F.lit("["))
    return drawn.where("kind <> 'email'").unionByName(
        address.withColumn(
            "surrogate",
            F.when(tagged, F.col("surrogate")).otherwise(F.concat_ws("@", local, "moved")),
        ).drop("domain", "moved")
    )


def names_of(found: DataFrame) -> DataFrame:
    """``doc_id, text_hash, word, kind, canonical``: the words that are names in a document
    because the corpus shows elsewhere that a pair's first word is a given name.

    A name that was seen with one gender has that, otherwise ``n``. A word that is given
    name in one pair and surname in another is the given name. Given names meet the distinct
    pairs, so that one frequent given name is no large group.
    """
    genders = F.array_remove(F.collect_set(F.substring("kind", len(LEARNED) + 1, 1)), "n")
    known = (
        found.where(F.startswith("kind", F.lit(LEARNED)))
        .groupBy(F.col("canonical").alias("given"))
        .agg(F.when(F.size(genders) == 1, F.get(genders, F.lit(0))).otherwise("n").alias("gender"))
    )
    words = F.split("canonical", " ")
    pair = found.where(F.col("kind") == MAYBE_NAME).select("doc_id", "text_hash", words.alias("w"))
    # Names among the distinct pairs, then back to the documents.
    distinct = pair.select("w").distinct().withColumn("given", F.col("w")[2]).join(known, "given")
    told = pair.join(distinct.select("w", "gender"), "w").select(
        "doc_id",
        "text_hash",
        F.explode(
            F.array(
                F.struct(
                    F.col("w")[0].alias("word"),
                    F.concat(F.lit("given_"), "gender").alias("kind"),
                    F.col("w")[2].alias("canonical"),
                ),
                F.struct(
                    F.col("w")[1].alias("word"),
                    F.lit("surname").alias("kind"),
                    F.col("w")[3].alias("canonical"),
                ),
            )
        ).alias("n"),
    )
    return (
        told.select("doc_id", "text_hash", "n.*")
        .groupBy("doc_id", "text_hash", "word", "canonical")
        .agg(F.min("kind").alias("kind"))
    )


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_entities, kinds`` for every row of ``doc_id, text``.

    ``kinds`` lists the kinds found, sorted. A text without entities, also null or empty,
    comes back as it is. The same ``key`` and corpus give the same surrogates. There is one
    row per input row, repeated rows included, and further columns are left out. Texts of
    any length take time in proportion to it.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    every = staged(mentions(rows).distinct(), "mentions")
    placed = every.where("start IS NOT NULL").withColumn("word", F.lit(None).cast("string"))
    # Names known from elsewhere in the corpus have no places yet: a text has them wherever
    # their word stands.
    found = placed.unionByName(staged(names_of(every), "names"), allowMissingColumns=True)
    mapping = surrogates(found.select("kind", "canonical").distinct(), secret)
    changes = (
        found.join(mapping, ["kind", "canonical"])
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "end", "word", "kind", "surrogate"))
            ).alias("changes")
        )
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            texts, counts, kinds = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "changes"))
            for text, changes in zip(*columns):
                spans = [
                    (x["start"], x["end"], x["kind"], x["surrogate"])
                    for x in changes or ()
                    if x["word"] is None
                ]
                names = {x["word"]: (x["kind"], x["surrogate"]) for x in changes or () if x["word"]}
                if names:
                    bare = _bare(text, [x[:2] for x in spans], set(names))
                    spans = sorted([*spans, *((a, b, *names[word]) for a, b, word in bare)])
                parts, at = [], 0
                for start, end, kind, value in spans:
                    parts += [text[at:start], render(kind, text[start:end], value)]
                    at = end
                texts.append("".join([*parts, text[at:]]) if parts else text)
                counts.append(len(spans))
                kinds.append(sorted({x[2] for x in spans}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(texts, pa.string()),
                    pa.array(counts, pa.int64()),
                    pa.array(kinds, pa.list_(pa.string())),
                ],
                ["doc_id", "text", "n_entities", "kinds"],
            )

    # Only texts that may have entities are shuffled to meet their changes.
    flagged = _flagged(rows)
    left, right = flagged.where("maybe").alias("r"), changes.alias("c")
    met = left.join(
        right,
        (F.col("r.text_hash") == F.col("c.text_hash")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")),
        "left",
    ).select("r.doc_id", "text", "changes")
    changed = met.mapInArrow(rewrite, "doc_id long, text string, n_entities long, kinds array<string>")
    rest = flagged.where("NOT maybe").select(
        "doc_id",
        "text",
        F.lit(0).cast("long").alias("n_entities"),
        F.array().cast("array<string>").alias("kinds"),
    )
    return changed.unionByName(rest)
