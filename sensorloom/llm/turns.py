"""Conversation structure repair by a rank-convergence parallel Viterbi.

A conversation's rows are faulty (blank, duplicate, truncated) and its roles need not follow the form
``(system? (user assistant)+)?``. The cheapest edits keep, rerole or delete rows and insert empty ones. They are
a shortest path through the rows and four states (nothing yet, after a system, user, or assistant row).

1. Rows are put in order by a range sort of conversation and turn, so a conversation of any size is spread over
   tasks; the first row of equal role and text is found by an aggregate and joined back by its place, a unique key.
2. Conversations are cut into chunks of ``CHUNK`` rows, one letter a row. Rows that must be deleted change no state
   and stay out of the recursion.
3. Every chunk computes backward costs, from its end to its start. The last chunk of a conversation knows
   the costs at its end, the others speculate. After some rows costs from different ends differ by a constant only
   (the matrix of the rows has rank one), and then they decide alike. Fix-up passes give each chunk the
   costs that its successor found; a chunk runs only until its old and new costs differ by a constant. Passes go on
   until nothing changes; pass p takes 2^p chunks of a conversation in a row in one task, one at a time, so there are
   log(chunks) passes at most.
4. With the costs at its end each chunk traces the least audit from each state it can be entered in; the
   chunks of a conversation are stitched in order, which reads its kept rows as a stream (a hash of the whole
   repaired conversation is asked for, so one task passes over them, holding one row).

Defined results: null roles and texts are one space, as are null ids and turns in the text that decides the damage.
Rows of equal turn are ordered by role, text hash and place of reading; null turns come first, null conversation
ids are one conversation. A role whose first character isn't ``s``, ``u`` or ``a`` (an empty one too) can't be kept.
An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorloom.llm.common import release, written

#: Rows of a chunk, a power of two.
CHUNK = 1 << 12
#: White space of texts, ends of sentences, costs of the edits.
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or reroled row leads, and a kept row by its role's first letter.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: Costs at the end of a conversation: nothing and an assistant row end well, others insert.
END = (0, 2 * INSERT, INSERT, 0)
#: Letters of rows: role (x: none of the form), upper case if truncated; blank and duplicate ones.
BLANK, DUPLICATE = "b", "d"


# ---------------------------------------------------------------- damage and faults


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of a conversation table with faults put in."""
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(said.cast("binary")) % 20
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        kind.alias("kind"),
    ).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _trimmed() -> Column:
    return F.rtrim(F.col("text"), F.lit(SPACE))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``: a number that orders each conversation's rows. Written."""
    rows = rows.withColumns({"mark": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "mark", "salt"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    return written(placed.select("conv_id", "turn", "role", "text", "place"), "ordered-turns")


def lettered(rows: DataFrame) -> DataFrame:
    """conv_id, chunk, place, turn, role, letter of ordered rows."""
    end = F.right(_trimmed(), F.lit(1))
    one = F.left("role", F.lit(1))
    letter = F.when(one.isin("s", "u", "a"), one).otherwise("x")
    letter = F.when(end == "", BLANK).when(end.isin(*ENDS), letter).otherwise(F.upper(letter))
    said = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))
    marked = rows.select("conv_id", "place", "turn", "role", letter.alias("letter"), said.alias("said"))
    seen = marked.groupBy("conv_id", "said").agg(F.min("place").alias("place"), F.count("*").alias("times"))
    # Few rows are said again, and each of them but the first is a duplicate: place is unique, no key is hot.
    firsts = seen.select("place", F.lit(True).alias("first"))
    marked = marked.drop("said").join(firsts, "place", "left")
    again = (F.col("letter") != BLANK) & F.isnull("first")
    return marked.select(
        "conv_id",
        F.shiftright("place", CHUNK.bit_length() - 1).alias("chunk"),
        "place",
        "turn",
        "role",
        F.when(again, DUPLICATE).otherwise(F.col("letter")).alias("letter"),
    )


# ---------------------------------------------------------------- costs


def _closed(costs: tuple) -> tuple:
    """Costs before a row that may also insert first: two insertions reach every state there is."""
    nothing, system, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(nothing, INSERT + user), min(system, INSERT + user), user, assistant


def _before(letter: str, costs: tuple) -> tuple:
    """Costs to go from before a row, given those from behind it."""
    fault, kept = TRUNCATED * letter.isupper(), KEPT.get(letter.lower())
    out = []
    for state in range(4):
        best = min(DELETE + costs[state], REROLE + fault + costs[NEXT[state]])
        if kept and kept[state] is not None:
            best = min(best, fault + costs[kept[state]])
        out.append(best)
    return _closed(tuple(out))


def _level(costs: tuple) -> tuple:
    least = min(costs)
    return tuple(c - least for c in costs)


def _free(letters: str) -> str:
    return letters.replace(BLANK, "").replace(DUPLICATE, "")


def _start(letters: str, end: tuple, known: tuple | None = None) -> tuple:
    """Level costs at a chunk's start. ``known``: an earlier end and the start found from it; once both ends'
    costs differ by a constant, the start is the earlier one's."""
    new, old = end, known[0] if known else None
    for letter in reversed(_free(letters)):
        new = _before(letter, new)
        if known:
            old = _before(letter, old)
            if _level(new) == _level(old):
                return known[1]
    return _level(new)


CHUNKS = "conv_id long, chunk long, ordinal long, last boolean, letters string, tail array<long>, head array<long>"


def _pass(chunks: DataFrame, number: int) -> DataFrame:
    """All chunks with their costs brought up to date, 2^number of a conversation in a row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, carried = None, None
        for batch in batches:
            tails, heads = [], []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "span", "given", "letters", "tail", "head"))
            for conv, span, given, letters, tail, head in zip(*columns, strict=True):
                end = carried if (conv, span) == at else tuple(given)
                if head is None:
                    carried = _start(letters, end)
                elif tuple(tail) != end:
                    carried = _start(letters, end, (tuple(tail), tuple(head)))
                else:
                    carried = tuple(head)
                at = conv, span
                tails.append(end), heads.append(carried)
            made = {c: batch.column(c) for c in ("conv_id", "chunk", "ordinal", "last", "letters")}
            made |= {c: pa.array(x, pa.list_(pa.int64())) for c, x in (("tail", tails), ("head", heads))}
            yield pa.RecordBatch.from_pydict(made)

    behind = Window.partitionBy("conv_id").orderBy("ordinal")
    end = F.array(*[F.lit(x).cast("long") for x in END])
    # The last chunk knows its end. The others take their successor's start, or at first speculate on the end.
    given = F.when(F.col("last"), end).otherwise(F.coalesce(F.lead("head").over(behind), end))
    spans = chunks.withColumns({"given": given, "span": F.shiftright("ordinal", number)})
    dealt = spans.repartition("conv_id", "span").sortWithinPartitions("conv_id", "span", F.desc("ordinal"))
    return written(dealt.mapInArrow(run, CHUNKS), "chunk-costs")


def settled(chunks: DataFrame) -> DataFrame:
    """Chunks (conv_id, chunk, letters) with the costs at their ends: conv_id, chunk, letters, tail, first."""
    of = Window.partitionBy("conv_id").orderBy("chunk")
    chunks = chunks.select(
        "conv_id",
        "chunk",
        (F.row_number().over(of) - 1).cast("long").alias("ordinal"),
        F.lead("chunk").over(of).isNull().alias("last"),
        "letters",
        F.lit(None).cast("array<long>").alias("tail"),
        F.lit(None).cast("array<long>").alias("head"),
    )
    behind = Window.partitionBy("conv_id").orderBy("ordinal")
    number = 0
    while True:
        chunks = _pass(chunks, number)
        ends = chunks.select("tail", F.lead("head").over(behind).alias("found"))
        if ends.where("found is not null and found != tail").isEmpty():
            return chunks.select("conv_id", "chunk", "letters", "tail", (F.col("ordinal") == 0).alias("first"))
        number += 1


# ---------------------------------------------------------------- tracing


def _traced(letters: str, ahead: list[tuple], state: int) -> tuple[str, int]:
    """The least audit of a chunk entered in ``state``, and its cost.

    ``ahead``: costs to go before each row that need not be deleted, and behind the last.
    """
    out, at, total = [], 0, 0
    for letter in letters:
        if letter in (BLANK, DUPLICATE):
            out.append("D")
            total += DELETE
            continue
        fault, kept = TRUNCATED * letter.isupper(), KEPT.get(letter.lower())
        now, behind = ahead[at], ahead[at + 1]
        while now[state] != DELETE + behind[state] and now[state] == INSERT + now[NEXT[state]]:
            out.append("I")
            total += INSERT
            state = NEXT[state]
        if now[state] == DELETE + behind[state]:
            out.append("D")
            total += DELETE
        elif kept and kept[state] is not None and now[state] == fault + behind[kept[state]]:
            out.append("K")
            total += fault
            state = kept[state]
        else:
            out.append("R")
            total += REROLE + fault
            state = NEXT[state]
        at += 1
    return "".join(out), total


def _audits(letters: str, tail: list, first: bool) -> tuple[list[str], list[int]]:
    ahead = [tuple(tail)]
    for letter in reversed(_free(letters)):
        ahead.append(_before(letter, ahead[-1]))
    ahead.reverse()
    made = [_traced(letters, ahead, state) for state in ((NOTHING,) if first else range(4))]
    return [audit for audit, _ in made], [cost for _, cost in made]


def traces(chunks: DataFrame) -> DataFrame:
    """conv_id, chunk, letters, and by the state a chunk is entered in: audits, costs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("letters", "tail", "first"))
            made = [_audits(*x) for x in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("conv_id", "chunk", "letters")}
                | {
                    "audits": pa.array([audits for audits, _ in made], pa.list_(pa.string())),
                    "costs": pa.array([costs for _, costs in made], pa.list_(pa.int64())),
                }
            )

    return chunks.mapInArrow(run, "conv_id long, chunk long, letters string, audits array<string>, costs array<long>")


# ---------------------------------------------------------------- stitching

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}
NAMES = {USER: "user", ASSISTANT: "assistant"}


class _Conversation:
    """What is known of one conversation while its chunks and rows pass by."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.audit = conv_id, NOTHING, []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.role, self.turns, self.least, self.turn = None, 0, None, None
        self.hash, self.fresh, self.pending = hashlib.sha256(), True, iter("")

    def opens(self, letters: str, audits: list, costs: list) -> None:
        """A chunk's trace, before its rows."""
        entered = self.state if len(audits) > 1 else 0
        self.audit.append(audits[entered])
        self.pending = iter(audits[entered])
        self.counts["cost"] += costs[entered]
        self.counts["blank"] += letters.count(BLANK)
        self.counts["duplicate"] += letters.count(DUPLICATE)
        self.counts["truncated"] += sum(map(str.isupper, letters))

    def line(self, role: str, text: str) -> None:
        if not self.fresh:
            self.hash.update(b"\n")
        self.fresh = False
        self.hash.update(role.encode())
        self.hash.update(b":")
        self.hash.update(text.encode())

    def inserted(self) -> None:
        self.state = NEXT[self.state]
        self.line(NAMES[self.state], "")

    def row(self, turn: int | None, role: str, text: str | None) -> None:
        if turn is not None:
            self.turns += turn != self.turn
            self.least = turn if self.least is None else self.least
            self.turn = turn
        if self.role is not None and self.role[:1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.role = role
        while (edit := next(self.pending)) == "I":
            self.inserted()
        if edit == "K":
            self.state = KEPT[role[0]][self.state]
            self.line(role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self.line(NAMES[self.state], text)

    def report(self) -> tuple:
        """The conversation's row, once rows are inserted that it needs at its end."""
        if self.turn is not None:
            self.counts["gaps"] = self.turn - self.least + 1 - self.turns
        while END[self.state]:
            self.inserted()
            self.audit.append("I")
            self.counts["cost"] += INSERT
        return self.conv_id, *self.counts.values(), "".join(self.audit), self.hash.hexdigest()


def stitched(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One report a conversation. ``rows`` are the ordered ones, ``found`` their traces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        schema = pa.schema([pa.field("conv_id", pa.int64()), *[pa.field(c, pa.int64()) for c in COUNTS]])
        schema = schema.append(pa.field("audit", pa.string())).append(pa.field("repaired_sha256", pa.string()))

        def made(reports: list[tuple]) -> pa.RecordBatch:
            columns = zip(*reports, strict=True) if reports else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            reports = []
            names = ("conv_id", "turn", "role", "text", "letters", "audits", "costs")
            for conv, turn, role, text, letters, *trace in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        reports.append(now.report())
                    now = _Conversation(conv)
                if letters is not None:
                    now.opens(letters, *trace)
                else:
                    now.row(turn, role, text)
            yield made(reports)
        if now is not None:
            yield made([now.report()])

    rows = rows.withColumn("chunk", F.shiftright("place", CHUNK.bit_length() - 1))
    both = rows.unionByName(found, allowMissingColumns=True)
    keys = [F.asc_nulls_first("conv_id"), "chunk", F.asc_nulls_first("place")]
    dealt = both.repartition("conv_id").sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, REPORT)


def repaired(conversations: DataFrame) -> DataFrame:
    """The contract's row for every conversation id: faults put in, counted, and repaired at least cost."""
    rows = ordered(damaged(conversations))
    letters = lettered(rows)
    chunks = letters.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("place", "letter"))).alias("rows"))
    chunks = chunks.select("conv_id", "chunk", F.array_join(F.col("rows.letter"), "").alias("letters"))
    found = traces(settled(chunks))
    reports = stitched(rows, found)
    release(conversations.sparkSession)
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    reports = reports.withColumnRenamed("conv_id", "of")
    every = ids.join(reports, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
