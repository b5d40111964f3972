"""Repair of the turns of a conversation by rank-convergence parallel Viterbi.

A conversation is right if the initials of its roles match ``(s?(ua)+)?``. The edits are: keep
a row (0), give it the role user or assistant (1), delete it (2), insert a user or assistant
row without text anywhere (5). A blank row, and one whose role and text stood earlier, must
be deleted; a truncated row that isn't deleted costs 5 more. Among the cheapest sequences of
edits the one whose initials (D, I, K, R) are least as ASCII text is taken.

What is still to be paid from a row on is a vector of four costs, one for each state of the
pattern, and follows from the vector of the next row. Instead of one long pass from the end
to the start, the rows are cut into chunks which all start at once from a guessed vector. A
fix-up pass gives a chunk the vector that its successor really has and reruns it until its
own vectors differ from the earlier ones by a constant only, from where on nothing else can
change. Passes go on until no chunk meets another vector than it was given. The stitched
costs then show, state by state, which edit stays on a cheapest path; as each initial leads
to one state only, the least letters are followed from the start. Chunks do that from all
four states at once and are put together.

This happens on two levels. Within a task, chunks of ``WIDTH`` rows of many conversations run
side by side in numpy arrays. Conversations with very many rows are cut into segments
(``Cutting``) that are run by different tasks; then the vectors between the segments are
fixed up by Spark jobs that rerun only the segments concerned. Rows travel as
(turn, role, digest of the text, code); texts are fetched by key for the rows that stay.

Defined results: a null conv_id, role or text is handled as follows: rows without a conv_id
are one conversation, a null role or text is one space. Rows stand by turn (nulls first),
then role, then SHA-256 of the text. Equal rows (also in the same turn) are copies, of which
all but the first are duplicates; they are counted before they are shuffled. Any length of
text and any role is allowed; only a role's initial matters. An empty table gives no rows.
Only conv_id, turn, role and text are read; other columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.saving import saved
from daybook.operators.segments import CUTS_OF_KEY, SEGMENT, Cutting, add_segments, same_keys

CUTTING = Cutting(smallest_segment=250_000)
WIDTH = 32
SPACE = "\t\n\x0b\f\r "

INSERT, DELETE, REROLE, CUT_OFF = 5, 2, 1, 5
#: States: nothing yet, after s, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a user or assistant row leads; just one of them fits each state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: What is to be inserted at the end.
END = np.array([0, 2 * INSERT, INSERT, 0])
#: A row's code is its initial (s, u, a or other) plus 4 if truncated, 8 if it has to go.
INITIALS = ("s", "u", "a")
MUST_GO = 8
NO_ROW = 12
NEVER = 1 << 40


def _code_tables():
    """For each code: what going on with the row costs by state, and opening with it."""
    code, state = np.arange(NO_ROW + 1)[:, None], np.arange(4)[None, :]
    goes = code >= MUST_GO
    extra = np.where((code >> 2) == 1, CUT_OFF, 0)
    fits = ((code & 3) == np.where(NEXT[state] == USER, 1, 2)) & ~goes
    take = np.where(goes, NEVER, extra + np.where(fits, 0, REROLE))
    opens = np.where(((code & 3) == 0) & ~goes, extra, NEVER)[:, 0]
    return take, fits, opens


TAKE, FITS, OPEN = _code_tables()
DROP = np.where(np.arange(NO_ROW + 1) == NO_ROW, 0, DELETE)


def before(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The costs from a row on, out of those after it."""
    best = np.minimum(after + DROP[code][:, None], TAKE[code] + after[:, NEXT])
    best[:, START] = np.minimum(best[:, START], OPEN[code] + after[:, SYSTEM])
    for _ in range(2):
        best = np.minimum(best, INSERT + best[:, NEXT])
    return best


def unlike(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Where two vectors differ by more than a constant."""
    shift = one - other
    return (shift != shift[:, :1]).any(axis=1)


def backward_costs(codes: np.ndarray, ends: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Costs[j, i]: from row j of chunk i on, right but for a constant in each chunk.

    Where ``joined``, a chunk goes on in the following one, and its end is only a guess.
    """
    count, width = codes.shape
    costs = np.empty((width + 1, count, 4), np.int64)
    costs[width] = ends
    for j in reversed(range(width)):
        costs[j] = before(codes[:, j], costs[j + 1])
    inner = np.flatnonzero(joined)
    while True:
        met = costs[0, inner + 1]
        wrong = unlike(met, costs[width, inner])
        live = inner[wrong]
        if not len(live):
            return costs
        costs[width, live] = met[wrong]
        for j in reversed(range(width)):
            now = before(codes[live, j], costs[j + 1, live])
            goes_on = unlike(now, costs[j, live])
            settled = live[~goes_on]
            costs[: j + 1, settled] += (now - costs[j, live])[~goes_on, 0][None, :, None]
            live = live[goes_on]
            costs[j, live] = now[goes_on]
            if not len(live):
                break


def follow(codes: np.ndarray, costs: np.ndarray, states: np.ndarray):
    """The least edits from the given states: letters, insertions before each row, the state
    in which the row was met, and the states at the end."""
    count, width = codes.shape
    lane = np.arange(count)
    letters = np.zeros((count, width), np.uint8)
    inserted = np.zeros((count, width), np.int8)
    met = np.zeros((count, width), np.int8)
    for j in range(width):
        code = codes[:, j]
        here, after = costs[j], costs[j + 1]
        for _ in range(2):
            drop = here[lane, states] == DROP[code] + after[lane, states]
            onward = NEXT[states]
            insert = ~drop & (here[lane, states] == INSERT + here[lane, onward])
            inserted[:, j] += insert
            states = np.where(insert, onward, states)
        now, onward = here[lane, states], NEXT[states]
        drop = now == DROP[code] + after[lane, states]
        opening = ~drop & (states == START) & (now == OPEN[code] + after[:, SYSTEM])
        keep = opening | FITS[code, states]
        letters[:, j] = np.where(drop, ord("D"), np.where(keep, ord("K"), ord("R")))
        met[:, j] = states
        states = np.where(drop, states, np.where(opening, SYSTEM, onward))
    letters[codes == NO_ROW] = 0
    return letters, inserted, met, states


class Lanes:
    """The rows of many segments in chunks of WIDTH, the chunks of a segment in a row."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray):
        self.sizes = sizes
        chunks = np.maximum(1, -(-sizes // WIDTH))
        stops = np.cumsum(chunks)
        self.first, self.last = stops - chunks, stops - 1
        within = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.lane, self.column = np.repeat(self.first, sizes) + within // WIDTH, within % WIDTH
        self.codes = np.full((stops[-1] if len(stops) else 0, WIDTH), NO_ROW)
        self.codes[self.lane, self.column] = codes
        joined = np.ones(len(self.codes), bool)
        joined[self.last] = False
        guess = np.zeros((len(self.codes), 4), np.int64)
        guess[self.last] = ends
        self.costs = backward_costs(self.codes, guess, joined)

    def starts(self) -> np.ndarray:
        return self.costs[0, self.first]

    def _states(self, given: np.ndarray) -> np.ndarray:
        """The state in which each chunk begins, where (segments, n) states are given."""
        states = np.zeros((len(self.codes), given.shape[1]), np.int64)
        states[self.first] = given
        several = np.flatnonzero(self.last > self.first)
        if len(several):
            lanes = np.concatenate([np.arange(self.first[i], self.last[i]) for i in several])
            four = np.repeat(lanes, 4)
            to = np.zeros((len(self.codes), 4), np.int64)
            ends = follow(self.codes[four], self.costs[:, four], np.tile(np.arange(4), len(lanes)))[3]
            to[lanes] = ends.reshape(-1, 4)
            at = self.first[several]
            while len(at):
                states[at + 1] = np.take_along_axis(to[at], states[at], axis=1)
                at = at + 1
                at = at[np.isin(at, self.last, invert=True)]
        return states

    def leads(self) -> np.ndarray:
        """Where each segment ends if it begins in each of the four states."""
        given = np.tile(np.arange(4), (len(self.sizes), 1))
        states = self._states(given)[self.last]
        four = np.repeat(self.last, 4)
        return follow(self.codes[four], self.costs[:, four], states.ravel())[3].reshape(-1, 4)

    def edits(self, given: np.ndarray):
        """Letters, insertions and states, by row, and the states at the segments' ends."""
        states = self._states(given[:, None])[:, 0]
        letters, inserted, met, ends = follow(self.codes, self.costs, states)
        at = self.lane, self.column
        return letters[at], inserted[at], met[at], ends[self.last]


def _codes(rows: pa.ListArray):
    """Codes of all rows, copies included, where each came from, and the sizes of the lists."""
    parts = rows.flatten()
    code, copies = (parts.field(name).to_numpy() for name in ("code", "copies"))
    offsets = rows.offsets.to_numpy()
    offsets = offsets - offsets[0]
    source = np.repeat(np.arange(len(code)), copies)
    codes = code[source].astype(np.int64)
    copy = np.concatenate([[False], source[1:] == source[:-1]]) if len(source) else np.zeros(0, bool)
    codes[copy] = MUST_GO + (codes[copy] & 3)
    until = np.concatenate([[0], np.cumsum(copies)])[offsets]
    return parts, codes, source, np.diff(until)


def _vectors(column: pa.Array, size: int = 4) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.int64()))


def _edited(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The edits of each segment, and the rows that result."""
    parts, codes, source, sizes = _codes(batch.column("rows"))
    lanes = Lanes(codes, sizes, _vectors(batch.column("ends")))
    letters, inserted, met, ends = lanes.edits(batch.column("state").to_numpy())
    closing = np.where(batch.column("last").to_numpy(zero_copy_only=False), END[ends] // INSERT, 0)

    # One more place per segment, for what is inserted at its end.
    stops = np.cumsum(sizes)
    places = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)
    tail = stops + np.arange(len(sizes))
    total = len(codes) + len(sizes)
    before_, letter, state, origin = (np.zeros(total, np.int64) for _ in range(4))
    before_[places], before_[tail] = inserted, closing
    letter[places], state[places], origin[places] = letters, met, source
    state[tail] = np.where(closing > 0, ASSISTANT, START)
    events = before_ + (letter > 0)
    until = np.cumsum(events)
    owner = np.repeat(np.arange(total), events)
    turn_in = np.arange(len(owner)) - (until - events)[owner]
    made = turn_in < before_[owner]
    written = np.where(made, ord("I"), letter[owner]).astype(np.uint8)

    # The last insertion before a row leads to the state in which it is met.
    left = before_[owner] - 1 - turn_in
    is_user = np.where(made, (state[owner] == USER) ^ (left % 2 == 1), NEXT[state[owner]] == USER)
    segment_of = np.repeat(np.arange(len(sizes)), sizes + 1)[owner]
    stays = written != ord("D")
    truncated = np.zeros(total, bool)
    truncated[places] = (codes >> 2) == 1
    price = np.select([made, written == ord("D"), written == ord("R")], [INSERT, DELETE, REROLE], 0)
    price = price + CUT_OFF * (truncated[owner] & ~made & stays)
    cost = np.zeros(len(sizes), np.int64)
    np.add.at(cost, segment_of, price)

    event_stops = np.concatenate([[0], until[tail]]).astype(np.int64)
    text = written.tobytes().decode("ascii")
    audits = [text[a:b] for a, b in zip(event_stops, event_stops[1:])]
    kept = np.flatnonzero(stays)
    counts = np.concatenate([[0], np.cumsum(np.bincount(segment_of[kept], minlength=len(sizes)))])
    rows = pa.array(np.where(made[kept], 0, origin[owner[kept]]), mask=made[kept])
    keys = [parts.field(name).take(rows) for name in ("turn", "role", "digest")]
    renamed = made[kept] | (written[kept] == ord("R"))
    roles = pa.array(np.where(is_user[kept], "user", "assistant").astype(object), pa.string(), mask=~renamed)
    spots = pa.array(kept - event_stops[segment_of[kept]], pa.int64())
    edits = pa.array(written[kept].view("S1").astype(str).astype(object), pa.string())
    out = pa.StructArray.from_arrays(
        [spots, edits, roles, *keys], names=["spot", "edit", "new_role", "turn", "role", "digest"]
    )

    initial = codes & 3
    inner = np.repeat(np.arange(len(sizes)), sizes)
    pair = inner[1:] == inner[:-1]
    wrong = pair & ~_legal(initial[:-1], initial[1:])
    illegal = np.bincount(inner[1:][wrong], minlength=len(sizes)) if len(inner) else np.zeros(len(sizes))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("conv_id"),
            batch.column("segment"),
            pa.array(cost),
            pa.array(audits, pa.string()),
            pa.array(illegal.astype(np.int64)),
            pa.array(initial[stops - sizes].astype(np.int64)),
            pa.array(initial[stops - 1].astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), out),
        ],
        names=["conv_id", "segment", "cost", "audit", "illegal", "first", "final", "out"],
    )


def _legal(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return ((one == 0) & (other == 1)) | ((one == 1) & (other == 2)) | ((one == 2) & (other == 1))


def _key(conversations: DataFrame) -> list[Column]:
    space = F.lit(" ")
    return [
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.unhex(F.sha2(F.coalesce("text", space), 256)).alias("digest"),
    ]


def judged_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, blank, duplicate, truncated, code) of unlike rows."""
    shown = F.rtrim(F.coalesce("text", F.lit(" ")), F.lit(SPACE))
    light = conversations.select(
        *_key(conversations),
        (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    names = ["conv_id", "turn", "role", "digest"]
    merged = saved(
        light.groupBy(*names, "blank", "truncated").agg(F.count("*").alias("copies")), "turns"
    )
    earliest = (
        merged.groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("place"))
        .select(F.col("place.turn").alias("at_turn"), *[F.col(x).alias(f"at_{x}") for x in ("conv_id", "role", "digest")])
    )
    on = same_keys(merged, earliest, names, "at_")
    seen = merged.join(earliest, on, "left").select(
        *merged.columns, F.col("at_digest").isNull().alias("seen")
    )
    initial = F.substring("role", 1, 1)
    code = F.lit(len(INITIALS))
    for number, letter in enumerate(INITIALS):
        code = F.when(initial == letter, number).otherwise(code)
    good = ~F.col("blank") & ~F.col("seen")
    return seen.select(
        *names,
        "copies",
        F.when(F.col("blank"), F.col("copies")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.when(F.col("seen"), 0).otherwise(1)).alias("duplicate"),
        F.when(good & F.col("truncated"), 1).otherwise(0).cast("bigint").alias("truncated"),
        (code + F.when(~good, MUST_GO).when(F.col("truncated"), 4).otherwise(0)).cast("int").alias("code"),
    )


def segments(conversations: DataFrame, cutting: Cutting = CUTTING) -> DataFrame:
    """The rows of each segment of a conversation in order, with their counts."""
    order = ["turn", "role", "digest"]
    cut = add_segments(judged_rows(conversations), ["conv_id"], order, cutting)
    turns = F.array_distinct(F.filter(F.transform("rows", lambda x: x["turn"]), lambda x: x.isNotNull()))
    return saved(
        cut.groupBy("conv_id", F.col(SEGMENT).alias("segment"), (F.col(CUTS_OF_KEY) > 0).alias("cut"))
        .agg(
            F.sort_array(F.collect_list(F.struct(*order, "code", "copies"))).alias("rows"),
            *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
            F.min("turn").alias("first_turn"),
            F.max("turn").alias("last_turn"),
        )
        .withColumn("turns", F.size(turns).cast("bigint")),
        "segments",
    )


_VECTORS = "conv_id bigint, segment int, ends array<bigint>, starts array<bigint>"


def _vector(values) -> Column:
    return F.array(*[F.lit(int(value)).cast("bigint") for value in values])


def _joined(rows: DataFrame, given: DataFrame) -> DataFrame:
    """Add columns of a table with one row per segment."""
    renamed = given.withColumnsRenamed({"conv_id": "at_conv_id", "segment": "at_segment"})
    on = same_keys(rows, renamed, ["conv_id", "segment"], "at_")
    return rows.join(renamed, on).drop("at_conv_id", "at_segment")


def _with_starts(rows: DataFrame) -> DataFrame:
    """Run the segments from the vectors that they are given."""

    def run(batches):
        for batch in batches:
            _, codes, _, sizes = _codes(batch.column("rows"))
            lanes = Lanes(codes, sizes, _vectors(batch.column("ends")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv_id", "segment", "ends")), _lists(lanes.starts())],
                names=["conv_id", "segment", "ends", "starts"],
            )

    return rows.select("conv_id", "segment", "ends", "rows").mapInArrow(run, _VECTORS)


def _stitched(several: DataFrame) -> DataFrame:
    """(conv_id, segment, ends, state, last) of the segments of conversations that were cut."""
    in_order = Window.partitionBy("conv_id").orderBy("segment")
    last = F.lead("segment").over(in_order).isNull()
    guessed = several.withColumn("ends", F.when(last, _vector(END)).otherwise(_vector([0] * 4)))
    known = saved(_with_starts(guessed), "vectors")

    def level(vector: Column) -> Column:
        return F.transform(vector, lambda x: x - vector[0])

    while True:
        met = known.withColumn("met", F.lead("starts").over(in_order))
        wrong = F.coalesce(level(F.col("met")) != level(F.col("ends")), F.lit(False))
        checked = saved(met.withColumn("wrong", wrong), "vectors")
        if not checked.filter("wrong").limit(1).count():
            break
        again = checked.filter("wrong").select("conv_id", "segment", F.col("met").alias("ends"))
        right = checked.filter("NOT wrong").select(*known.columns)
        known = saved(right.unionByName(_with_starts(_joined(several, again))), "vectors")

    def lead(batches):
        for batch in batches:
            _, codes, _, sizes = _codes(batch.column("rows"))
            lanes = Lanes(codes, sizes, _vectors(batch.column("ends")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("segment"), _lists(lanes.leads())],
                names=["conv_id", "segment", "leads"],
            )

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("segment").combine_chunks()
        states, now = [], START
        for to in table.column("leads").to_pylist():
            states.append(now)
            now = to[now]
        final = [False] * (len(states) - 1) + [True]
        return pa.table(
            {
                "conv_id": table.column("conv_id"),
                "segment": table.column("segment"),
                "state": pa.array(states, pa.int32()),
                "last": pa.array(final),
            }
        )

    ends = known.select("conv_id", "segment", "ends")
    leads = _joined(several, ends).select("conv_id", "segment", "ends", "rows").mapInArrow(
        lead, "conv_id bigint, segment int, leads array<bigint>"
    )
    states = leads.groupBy("conv_id").applyInArrow(
        chain, "conv_id bigint, segment int, state int, last boolean"
    )
    return saved(_joined(ends, states), "stitched")


def edited(parts: DataFrame) -> DataFrame:
    """The edits of each segment and the rows that they leave."""

    def run(batches):
        for batch in batches:
            if len(batch):
                yield _edited(batch)

    names = ["conv_id", "segment", "ends", "state", "last", "rows"]
    whole = parts.filter("NOT cut").select(
        "conv_id",
        "segment",
        _vector(END).alias("ends"),
        F.lit(START).alias("state"),
        F.lit(True).alias("last"),
        "rows",
    )
    several = parts.filter("cut").select("conv_id", "segment", "rows")
    if several.limit(1).count():
        whole = whole.unionByName(_joined(several, _stitched(several)).select(*names))
    return saved(
        whole.mapInArrow(
            run,
            "conv_id bigint, segment int, cost bigint, audit string, illegal bigint, "
            "first bigint, final bigint, out array<struct<spot: bigint, edit: string, new_role: string, "
            "turn: bigint, role: string, digest: binary>>",
        ),
        "edited",
    )


def kept_rows(conversations: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, segment, spot, edit, role, text): the repaired rows, by segment and spot."""
    out = edits.select("conv_id", "segment", F.inline("out"))
    names = ["conv_id", "turn", "role", "digest"]
    text = F.first(F.coalesce("text", F.lit(" "))).alias("at_text")
    texts = (
        conversations.select(*_key(conversations), "text")
        .groupBy(*names)
        .agg(text)
        .withColumnsRenamed({name: f"at_{name}" for name in names})
    )
    given = out.filter(F.col("digest").isNotNull())
    found = given.join(texts, same_keys(given, texts, names, "at_")).select(
        "conv_id",
        "segment",
        "spot",
        "edit",
        F.coalesce("new_role", "role").alias("role"),
        F.col("at_text").alias("text"),
    )
    made = out.filter(F.col("digest").isNull()).select(
        "conv_id", "segment", "spot", "edit", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    return found.unionByName(made)


def row_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the rows of each conversation, as they stream by in their order.

    SHA-256 takes its input in order, so a conversation is read by one task, a batch at a
    time.
    """

    def run(batches):
        # The rows of a conversation come one after the other, maybe over several batches.
        now, digest = None, None
        for batch in batches:
            done = ([], [])
            for conv, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))):
                if digest is not None and conv == now:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        done[0].append(now)
                        done[1].append(digest.hexdigest())
                    now, digest = conv, hashlib.sha256()
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.string())], ["conv_id", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], ["conv_id", "sha256"])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "spot")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id bigint, sha256 string")


def repair_report(
    conversations: DataFrame, ids: DataFrame | None = None, cutting: Cutting = CUTTING
) -> DataFrame:
    """Faults, cost, edits and digest of the repaired rows of each conversation.

    ``ids`` may name conversations of which no row is left; their counts are zero.
    """
    parts = segments(conversations, cutting)
    edits = edited(parts)
    measures = parts.drop("rows", "cut")
    in_order = Window.partitionBy("conv_id").orderBy("segment")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    linked = _joined(measures, edits.drop("out"))
    previous = F.lag("final").over(in_order)
    legal = (
        ((previous == 0) & (F.col("first") == 1))
        | ((previous == 1) & (F.col("first") == 2))
        | ((previous == 2) & (F.col("first") == 1))
    )
    crossed = linked.select(
        "*",
        F.when(previous.isNull() | legal, 0).otherwise(1).alias("between"),
        F.when(F.max("last_turn").over(earlier) == F.col("first_turn"), 1).otherwise(0).alias("again"),
    )
    per_conversation = crossed.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns") + F.sum("again"), F.lit(0)).alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.sum("between")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), ""
        ).alias("audit"),
    )
    digests = row_digests(kept_rows(conversations, edits)).withColumnRenamed("conv_id", "at_conv_id")
    named = per_conversation.join(
        digests, same_keys(per_conversation, digests, ["conv_id"], "at_"), "left"
    ).drop("at_conv_id")
    if ids is not None:
        every = ids.select(F.col("conv_id").cast("bigint").alias("at_conv_id")).distinct()
        named = every.join(named, same_keys(named, every, ["conv_id"], "at_"), "left").drop("conv_id")
        named = named.withColumnRenamed("at_conv_id", "conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return named.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoilt by a checksum of conversation and turn, to test the repair with."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(name) % 20).alias("fault"),
    ).filter("fault <> 0")
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
