"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Everything is Spark's own expressions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table

# Each pattern finds the leftmost matches of its kind.  Possessive runs and a look behind keep the
# search linear on very long runs: a match can only begin where its run begins, or, for emails,
# where the match before ended.
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"


def _card(least: int, most: int) -> str:
    """A whole run of digits, single blanks or hyphens between them, of so many digits."""
    return rf"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){{{least - 1},{most - 1}}}+(?![ -]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.  A span is kept when ``score`` plus ``bonus`` (if a context word
    stands within ``CONTEXT`` characters before it) reaches ``KEEP``."""

    name: str
    pattern: str
    hint: str  # the kind can't occur in a text without this pattern
    confirmed: str  # check of a match: "", "ip", "digits", "luhn" or "mod97"
    score: float
    words: str
    bonus: float = 0.3


KEEP, CONTEXT = 0.5, 40
RUN = 256  # matches of one inner fold
BASE = (
    Kind("email", EMAIL, "@", "", 0.6, "mail|contact|write|address"),
    Kind("ip", IP, r"[0-9]\.[0-9]", "ip", 0.5, "ip|host|server|address"),
    Kind("card", _card(16, 19), "[0-9]", "luhn", 0.7, "card|visa|credit|payment|pay"),
    Kind("phone", PHONE, r"\+[0-9]", "digits", 0.6, "phone|tel|call|mobile|fax"),
)
ADDED = (
    Kind("iban", IBAN, "[A-Z]{2}[0-9]{2}", "mod97", 0.7, "iban|account|bank|transfer"),
    # Shorter card numbers are too often chance: they need a context word.
    Kind("card_short", _card(13, 15), "[0-9]", "luhn", 0.3, "card|amex|credit|payment"),
)


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: text.substr(i, F.lit(1)))


def luhn(digits: Column) -> Column:
    def weighed(c: Column, i: Column) -> Column:
        n = c.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    total = F.aggregate(F.transform(_chars(F.reverse(digits)), weighed), F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def mod97(text: Column) -> Column:
    """The remainder rule of account numbers: first four characters to the end, letters as 10-35."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 1000), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(turned), F.lit(0), step) == 1


def _confirmed(kind: Kind, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind.confirmed == "luhn":
        return luhn(digits)
    if kind.confirmed == "mod97":
        return mod97(match)
    if kind.confirmed == "digits":
        return F.length(digits).between(8, 15)
    if kind.confirmed == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    return F.lit(True)


def _spans(text: Column, kind: Kind, order: int) -> Column:
    """Confirmed matches as an array of structs.

    The pieces between the matches give their places: one fold over pieces and matches carries the place reached and
    the last ``CONTEXT`` characters, so the work grows with the text, however many matches it has.  The fold goes by runs
    of ``RUN`` matches, because each span added copies the array it is added to."""
    empty = F.expr("CAST(array() AS array<struct<kind:string,rank:int,start:int,end:int,score:double>>)")
    none = F.expr("CAST(array() AS array<struct<match:string,start:int,near:string>>)")
    parts = F.arrays_zip(F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)))
    most = F.lit(CONTEXT)

    def step(done: Column, part: Column) -> Column:
        piece, match = part["0"], part["1"]  # no match after the last piece
        start = done["at"] + F.length(piece)
        near = F.right(F.concat(done["near"], F.right(piece, most)), most)
        found = F.struct(match.alias("match"), start.alias("start"), near.alias("near"))
        found = F.when(_confirmed(kind, match), F.concat(done["found"], F.array(found))).otherwise(done["found"])
        after = F.right(F.concat(near, F.right(match, most)), most)
        return F.when(match.isNull(), done).otherwise(F.struct((start + F.length(match)).alias("at"), after.alias("near"), found.alias("found")))

    def scored(m: Column) -> Column:
        bonus = F.when(F.lower(m["near"]).rlike(rf"\b({kind.words})"), kind.bonus).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(order).alias("rank"),
            m["start"].alias("start"),
            (m["start"] + F.length(m["match"])).alias("end"),
            F.round(F.lit(kind.score) + bonus, 2).alias("score"),
        )

    def by_runs(parts: Column) -> Column:
        def run(done: Column, at: Column) -> Column:
            begin = F.struct(done["at"].alias("at"), done["near"].alias("near"), none.alias("found"))
            return F.aggregate(
                F.slice(parts, at, F.lit(RUN)), begin, step, lambda x: F.struct(x["at"], x["near"], F.concat(done["found"], x["found"]).alias("found"))
            )

        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("near"), none.alias("found"))
        return F.aggregate(F.sequence(F.lit(1), F.size(parts), F.lit(RUN)), begin, run, lambda done: done["found"])

    # As the argument of a function the parts are worked out once, not for each run.
    found = F.element_at(F.transform(F.array(parts), by_runs), 1)
    kept = F.filter(F.transform(found, scored), lambda s: s["score"] >= KEEP)
    return F.when(text.rlike(kind.hint), kept).otherwise(empty)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds=BASE + ADDED) -> DataFrame:
    """One row per row of ``df``: its id and ``spans``, an array of (kind, rank, start, end, score),
    by kind, then start; offsets in code points, end exclusive.

    A null or empty text has no spans; a very long one is searched whole.  Repeated rows are answered each.  Columns other than id and
    text are left out, so their names can't clash.  An empty table gives an empty result."""
    slim = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = slim.select("_id", *[_spans(F.col("_text"), k, i).alias(f"_k{i}") for i, k in enumerate(kinds)])
    return found.select(F.col("_id").alias(id_col), F.concat(*[f"_k{i}" for i in range(len(kinds))]).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def masked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sign: str = "[{}]") -> DataFrame:
    """Id and text with every span replaced by its kind; spans that overlap an earlier one go with it.

    Same treatment of nulls, repeated rows and further columns as ``find_pii``."""
    slim = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    spans = F.array_sort(F.concat(*[F.transform(_spans(F.col("_text"), k, i), lambda s: F.struct(s["start"], s["end"], s["kind"])) for i, k in enumerate(BASE + ADDED)]))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    before, after = sign.split("{}")

    def step(acc: Column, s: Column) -> Column:
        gap = F.col("_text").substr(acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.concat(acc["out"], gap, F.lit(before), s["kind"], F.lit(after))
        return F.when(s["start"] >= acc["at"], F.struct(out.alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))
        )

    done = F.aggregate(F.col("_spans"), start, step, lambda a: F.concat(a["out"], F.col("_text").substr(a["at"] + 1, F.length("_text"))))
    return slim.withColumn("_spans", spans).select(F.col("_id").alias(id_col), done.alias(text_col))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the personal data in every document."""
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def number(kind: Kind) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind.name)).cast("long").alias(f"n_{kind.name}")

    counts = [number(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))
