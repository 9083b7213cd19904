"""Chat formatting: transcripts to canonical turns by a hidden Markov model.

A transcript is plain text in which speakers alternate, with or without
markers ("User:", "Q:", "### Assistant", ...).  Every line is an observation
of a few discrete features (speaker marker, blank line before, first line,
length class, last character); the hidden state is the role of the line's
speaker and whether the line begins a turn.  Start, transition and emission
probabilities are smoothed counts over labelled transcripts, gathered by
Spark; Viterbi recovers the states of each transcript, and its turns are
rendered in one canonical form.  The marker of a turn's first line is removed;
the other lines of a turn, blank ones between them too, stay as they are.

Conversation rows become transcripts by one exchange of the texts: ranges of
(conversation, and in conversations of more than ``CHUNK`` rows turn, role and
hash of the text too), so that a long conversation is spread over tasks
whatever its turn numbers are.  Each task cuts its sorted rows into pieces of
at most ``CHUNK`` rows and ``CHUNK_CHARS`` characters; a conversation that
needs no cut is one piece.  A longer one is still one transcript: its pieces
are summed up as matrices of best scores from each entering to each leaving
state, ``FAN`` neighbours at a time become one matrix until a conversation
has no more than ``FAN``, and on the way back each piece learns the states
between which it lies on the best path of the whole.  The renderings of its
pieces, joined in the order of ``chunk``, are the rendering of the
conversation; where a piece ends is a matter of layout, not of the result.
Scores are whole numbers (``SCALE`` a nat), so sums do not depend on the cuts.

Defined cases: null and empty transcripts have no turns and render as "";
null texts of turns are empty; a turn without text or marker leaves no line
and is no part of its transcript, and a conversation of such turns alone is one
empty transcript; white space behind a turn is dropped; null roles are not learned
from; rows with a null turn number come first, equal turn numbers are ordered by
role and text (in long conversations by role and the text's hash); repeated
rows of a conversation count once; rows with a null conversation are one conversation;
transcripts of any length are parsed whole; an empty table gives an empty
result; extra columns are ignored, clashing names replaced.  Equally likely
paths: the earlier state, within a piece.  A marker that stands alone at the end
of a piece, with its turn going on in the next, keeps the line break behind it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.llm.common import arrow_map, arrow_type, held_out, map_text, maybe_in, parts_of, ship, staged, table

CHUNK = 512
CHUNK_CHARS = 1 << 22
FAN = 512
SCALE = 1 << 16
ROLES = ("assistant", "system", "user")
STATES = tuple((r, first) for r in ROLES for first in (True, False))
# Words that name a speaker, by role.
SPEAKERS = {"assistant": ("assistant", "ai", "bot", "model", "answer", "a", "gpt"),
            "system": ("system", "instructions", "context", "setup"),
            "user": ("user", "human", "question", "q", "me", "prompter", "customer")}
_ROLE_OF = {w: r for r, words in SPEAKERS.items() for w in words}
_MARKER = re.compile(r"^\s*(?:#{1,4}\s*|<\|?|\*\*|\[)?(" + "|".join(sorted(_ROLE_OF, key=len, reverse=True))
                     + r")(?:\s*(?:\*\*)?\s*[:>\]]\s*(?:\*\*)?|\|?>|\s*$)\s*", re.I)
FEATURES = ("marker", "gap", "first", "size", "end")
BEGIN = len(STATES)          # the state before the first line
TURNS = "array<struct<role:string,text:string>>"
# Fixed value: all that is not white space.
SEEN = r"[^\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def marker(line: str) -> tuple[str, str]:
    """(role named by the line's marker or "", the line without it)."""
    m = _MARKER.match(line)
    return (_ROLE_OF[m[1].lower()], line[m.end():]) if m else ("", line)


def observe(text: str, head: bool = True) -> list[tuple[str, tuple]]:
    """(line behind the blank lines before it, features) of the non-blank
    lines; ``head``: a transcript begins with this text."""
    out, blanks = [], ""
    for line in text.split("\n"):
        if not line.strip():
            blanks += line + "\n"
            continue
        role, body = marker(line)
        size = min(4, len(body) // 60)
        end = body.rstrip()[-1:]
        out.append((blanks + line, (role, bool(blanks), head and not out, size, end if end in ".?!:," else "")))
        blanks = ""
    return out


class Model:
    """Log probabilities of a hidden Markov model over STATES."""

    def __init__(self, starts: dict, moves: dict, seen: dict):
        n = len(STATES)
        self.start = np.log(np.array([starts.get(s, 0) + 0.1 for s in STATES]))
        self.start -= np.logaddexp.reduce(self.start)
        counts = np.array([[moves.get((a, b), 0) + 0.1 for b in STATES] for a in STATES])
        for i, (role, _) in enumerate(STATES):       # a turn goes on, or another one begins
            for j, (other, first) in enumerate(STATES):
                if not first and other != role:
                    counts[i, j] = 1e-9
        self.move = np.log(counts / counts.sum(axis=1, keepdims=True))
        self.seen, self.default = {}, {}
        for k, feature in enumerate(FEATURES):
            values = {v for f, _, v in seen if f == feature}
            total = [sum(c for (f, s, _), c in seen.items() if f == feature and s == state) for state in STATES]
            for v in values:
                self.seen[k, v] = np.array([np.log((seen.get((feature, s, v), 0) + 0.1) / (t + 0.1 * (len(values) + 1)))
                                            for s, t in zip(STATES, total)])
            self.default[k] = np.log([0.1 / (t + 0.1 * (len(values) + 1)) for t in total])
        self.n = n
        self.start, self.move = np.round(self.start * SCALE), np.round(self.move * SCALE)
        self.steps = np.full((n + 1, n + 1), -np.inf)
        self.steps[:n, :n], self.steps[BEGIN, :n] = self.move, self.start

    def emission(self, features: tuple) -> np.ndarray:
        return np.round(SCALE * sum(self.seen.get((k, str(v)), self.default[k]) for k, v in enumerate(features)))

    def viterbi(self, observed: list[tuple], enter: int = BEGIN, leave: int | None = None) -> list[int]:
        """Most likely states behind ``enter`` (and up to ``leave``); ties go
        to the earlier state."""
        if not observed:
            return []
        best, back = self.steps[enter, :self.n] + self.emission(observed[0]), []
        for features in observed[1:]:
            ways = best[:, None] + self.move
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + self.emission(features)
        path = [int(best.argmax()) if leave is None else leave]
        for came in reversed(back):
            path.append(int(came[path[-1]]))
        return path[::-1]

    def matrix(self, observed: list[tuple]) -> np.ndarray:
        """Best score of the lines for each state before them and at their end."""
        whole = np.where(np.eye(self.n + 1, dtype=bool), 0.0, -np.inf)
        for features in observed:
            step = self.steps.copy()
            step[:, :self.n] += self.emission(features)
            whole = chained(whole, step)
        return whole

    def piece(self, text: str | None, enter: int = BEGIN, leave: int | None = None) -> tuple[list[dict], bool]:
        """Turns of a piece of a transcript, and whether the first one goes
        on from the piece before."""
        observed = observe(text or "", enter == BEGIN)
        features = [f for _, f in observed]
        path = self.viterbi(features) if enter == BEGIN and leave is None else self.viterbi(features, enter, leave)
        out: list[dict] = []
        speaks = None if enter == BEGIN else STATES[enter][0]
        goes_on = bool(path) and speaks is not None and STATES[path[0]] == (speaks, False)
        for (line, _), state in zip(observed, path):
            role, first = STATES[state]
            if not out and goes_on:
                out.append({"role": role, "text": line})
            elif first or role != speaks:
                out.append({"role": role, "text": marker(line)[1]})
            else:                                        # whatever it starts with belongs to the turn
                out[-1]["text"] += "\n" + line
            speaks = role
        return [{"role": t["role"], "text": t["text"].rstrip() if goes_on and not i else t["text"].strip()}
                for i, t in enumerate(out)], goes_on

    def turns(self, text: str | None) -> list[dict]:
        return self.piece(text)[0]


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None]).max(axis=1)


def between(matrices: list[np.ndarray], enter: int, leave: int | None) -> list[int]:
    """States before the first, between and behind the matrices on the best
    path from ``enter`` (to ``leave``)."""
    best, back = np.full(BEGIN + 1, -np.inf), []
    best[enter] = 0.0
    for m in matrices:
        ways = best[:, None] + m
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0)
    path = [int(best.argmax()) if leave is None else leave]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    return path[::-1]


def render(turns: list[dict], goes_on: bool = False, inside: bool = False, last: bool = True) -> str:
    """The canonical form of a conversation, or of a piece ``inside`` one; an
    open turn is closed where the next one begins and behind the ``last``."""
    out, end = "", "<|im_end|>\n"
    for i, t in enumerate(turns):
        if goes_on and not i:
            out += "\n" + t["text"]
        else:
            out += (end if i or inside else "") + f"<|im_start|>{t['role']}\n{t['text']}"
    return out + (end if turns and last else "")


# -- conversations to labelled transcripts --------------------------------------
STYLES = ({"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
          {"system": "### Instructions:\n", "user": "### Human:\n", "assistant": "### AI:\n"},
          {"system": "", "user": "Q: ", "assistant": "A: "},
          {"system": "", "user": "", "assistant": ""})


def transcripts(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, chunk, last, text, roles, lines): the turns of a conversation
    put together as plain text in one of STYLES, drawn by its id, with the true
    role of each turn and its number of lines.  Longer conversations have several rows,
    numbered by ``chunk``; their texts follow each other line by line."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    mark = F.lit("")
    for k, names in enumerate(STYLES):
        for role, prefix in names.items():
            mark = F.when((style == k) & (F.col("role") == role), F.lit(prefix)).otherwise(mark)
    rows = conversations.select("conv_id", F.xxhash64("conv_id").alias("key"), F.col("turn").cast("long").alias("turn"),
                                "role", F.concat(mark, F.coalesce("text", F.lit(""))).alias("said"),
                                (style == len(STYLES) - 1).alias("wide"))
    sizes = staged(rows.groupBy("conv_id", "key").agg(F.count_if(F.col("said").rlike(SEEN)).alias("n")), "turn-counts")
    rows = rows.where(F.col("said").rlike(SEEN))
    many = sizes.where(F.col("n") > chunk).select("key").distinct()
    spread = maybe_in(rows, "key", many, inside=False).select(
        "conv_id", "turn", "role", "said", "wide", F.lit(False).alias("big")).unionByName(
        maybe_in(rows, "key", many).select("conv_id", "turn", "role", "said", "wide", F.lit(True).alias("big")))
    pieces = staged(_pieces(spread, chunk), "pieces")
    short = pieces.where("not more").select("conv_id", F.lit(0).cast("long").alias("chunk"), F.lit(True).alias("last"),
                                            "text", "roles", "lines")
    # Pieces of longer conversations are numbered by counts per task.
    long = pieces.where("more")
    counts = long.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    conv = Window.partitionBy("conv_id")
    before = counts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"),
                           (F.sum("n").over(conv.orderBy("part")) - F.col("n")).alias("before"),
                           F.sum("n").over(conv).alias("total"))
    at = F.col("before") + F.col("no")
    lead = F.when((style == len(STYLES) - 1) & (F.col("no") == 0) & (at > 0), F.lit("\n")).otherwise(F.lit(""))
    long = long.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(
        "conv_id", at.alias("chunk"), (at + 1 == F.col("total")).alias("last"), F.concat(lead, "text").alias("text"),
        "roles", "lines")
    silent = sizes.where("n = 0").select("conv_id", F.lit(0).cast("long").alias("chunk"), F.lit(True).alias("last"),
                                         F.lit("").alias("text"), F.array().cast("array<string>").alias("roles"),
                                         F.array().cast("array<int>").alias("lines"))
    return short.unionByName(long).unionByName(silent)


def _pieces(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv_id, part, no, more, text, roles, lines): the rows in order, cut
    into pieces; ``more`` tells that the conversation may have several."""
    def once(batches):
        # Repeats are taken out of each batch before they are exchanged.
        for batch in batches:
            t = pa.Table.from_batches([batch])
            yield from t.group_by(t.column_names).aggregate([]).to_batches()

    few = arrow_map(rows, once, rows.schema)
    keys = [F.when(F.col("big"), F.col(c)) for c in ("turn", "role")] + [F.when(F.col("big"), F.xxhash64("said"))]
    few = few.select("*", *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    sorted_rows = (few.repartitionByRange("conv_id", "k0", "k1", "k2")
                   .sortWithinPartitions("conv_id", "turn", "role", "k2", "said"))
    id_type = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", id_type)] + list(T.StructType.fromDDL(
        "part long, no long, more boolean, text string, roles array<string>, lines array<int>")))
    fields = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema])

    def cut(batches):
        part = TaskContext.get().partitionId()
        conv, no, size, held, before = None, 0, 0, [], None

        def piece(more: bool) -> dict:
            gap = "\n\n" if held[0][2] else "\n"
            texts = [said.rstrip() for _, said, _ in held]
            lead = gap[1:] if no else ""             # the rest of the gap behind the piece before
            return {"conv_id": conv, "part": part, "no": no, "more": more, "text": lead + gap.join(texts),
                    "roles": [role or "" for role, _, _ in held],
                    "lines": [sum(1 for line in t.split("\n") if line.strip()) for t in texts]}

        big = False
        for batch in parts_of(batches):
            made = []
            for c, turn, role, said, wide, is_big in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if (c, turn, role, said) == before and held:
                    continue
                if held and c != conv:
                    made.append(piece(big or no > 0))
                    no, size, held = 0, 0, []
                elif held and (len(held) >= chunk or size >= CHUNK_CHARS):
                    made.append(piece(True))
                    no, size, held = no + 1, 0, []
                conv, big, before = c, is_big, (c, turn, role, said)
                held.append((role, said, wide))
                size += len(said)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=fields)
        if held:
            yield pa.RecordBatch.from_pylist([piece(big or no > 0)], schema=fields)

    return arrow_map(sorted_rows.select("conv_id", "turn", "role", "said", "wide", "big"), cut, schema)


def learn(labelled: DataFrame) -> Model:
    """A model from transcripts with roles and lines (see ``transcripts``)."""
    def count(batches):
        from collections import Counter
        for batch in batches:
            seen: Counter = Counter()
            for text, roles, sizes, chunk in zip(*(batch.column(k).to_pylist() for k in range(4))):
                states = [(r, i == 0) for r, n in zip(roles, sizes) for i in range(n)]
                observed = observe(text, chunk == 0)
                if len(states) != len(observed) or any(r not in ROLES for r, _ in states):
                    continue
                for i, (state, (_, features)) in enumerate(zip(states, observed)):
                    if i or not chunk:
                        seen[("move" if i else "start", STATES.index(states[i - 1]) if i else -1,
                              STATES.index(state), "")] += 1
                    for name, v in zip(FEATURES, features):
                        seen[(name, -1, STATES.index(state), str(v))] += 1
            rows = list(seen.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
                 pa.array([k[2] for k, _ in rows], pa.int32()), pa.array([k[3] for k, _ in rows], pa.string()),
                 pa.array([n for _, n in rows], pa.int64())], names=["kind", "before", "state", "value", "n"])

    counted = (arrow_map(labelled.select("text", "roles", "lines", "chunk"), count,
                         "kind string, before int, state int, value string, n long")
               .groupBy("kind", "before", "state", "value").agg(F.sum("n").alias("n")).collect())   # a few hundred rows
    starts = {STATES[r.state]: r.n for r in counted if r.kind == "start"}
    moves = {(STATES[r.before], STATES[r.state]): r.n for r in counted if r.kind == "move"}
    seen = {(r.kind, STATES[r.state], r.value): r.n for r in counted if r.kind in FEATURES}
    return Model(starts, moves, seen)


def format_chats(transcript_rows: DataFrame, model: Model, text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Transcripts with turns (role, text), n_turns and rendered."""
    shared = transcript_rows.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        turns = [shared.value.turns(t) for t in texts]
        return turns, [len(t) for t in turns], [render(t) for t in turns]

    return map_text(transcript_rows, run, f"turns {TURNS}, n_turns int, rendered string", text_col, keep)


def ways(pieces: DataFrame, model: Model, fan: int = FAN) -> DataFrame:
    """(conv_id, chunk, enter, leave): the states before and at the end of each
    piece on the best path of its whole conversation.  No task gathers more than
    ``fan`` matrices of a conversation."""
    spark = pieces.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    side = BEGIN + 1
    conv = pieces.schema["conv_id"]
    sums = T.StructType([conv] + list(T.StructType.fromDDL("chunk long, m binary")))
    names = pa.schema([(f.name, arrow_type(f.dataType)) for f in sums])
    placed = T.StructType([conv] + list(T.StructType.fromDDL("chunk long, enter int, leave int")))

    def scored(batches):
        for batch in parts_of(batches):
            ms = [shared.value.matrix([f for _, f in observe(t or "", c == 0)]).tobytes()
                  for c, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ms, pa.binary())], schema=names)

    def matrices(t):
        return [np.frombuffer(m, dtype=np.float64).reshape(side, side) for m in t["m"].to_pylist()]

    def joined(t):
        t = t.sort_by("chunk")
        whole, *others = matrices(t)
        for m in others:
            whole = chained(whole, m)
        return pa.table([t["conv_id"].slice(0, 1), t["up"].slice(0, 1), pa.array([whole.tobytes()], pa.binary())],
                        schema=names)

    def dealt(t):
        t = t.sort_by("chunk")
        path = between(matrices(t), t["enter"][0].as_py(), t["leave"][0].as_py())
        return pa.table([t["conv_id"], t["chunk"], pa.array(path[:-1], pa.int32()), pa.array(path[1:], pa.int32())],
                        names=["conv_id", "chunk", "enter", "leave"])

    up = F.floor(F.col("chunk") / fan).cast("long").alias("up")
    levels = [staged(arrow_map(pieces.select("conv_id", "chunk", "text"), scored, sums), "piece-scores")]
    most = levels[0].agg(F.max("chunk")).first()[0] or 0
    while most >= fan:
        levels.append(staged(levels[-1].select("*", up).groupBy("conv_id", "up").applyInArrow(joined, sums), "piece-scores"))
        most //= fan
    above = None
    for level in reversed(levels):
        inside = level.select("*", up)
        if above is None:
            inside = inside.select("*", F.lit(BEGIN).alias("enter"), F.lit(None).cast("int").alias("leave"))
        else:
            parent = above.select(F.col("conv_id").alias("c"), F.col("chunk").alias("g"), "enter", "leave")
            inside = inside.join(parent, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("g")))
        above = staged(inside.select("conv_id", "chunk", "m", "up", "enter", "leave")
                       .groupBy("conv_id", "up").applyInArrow(dealt, placed), "piece-states")
    return above


def format_conversations(rows: DataFrame, model: Model, fan: int = FAN) -> DataFrame:
    """The rows of ``transcripts`` with turns, goes_on (the first turn began in
    the piece before), n_turns (that begin here) and rendered."""
    whole = F.col("last") & (F.col("chunk") == 0)
    short = rows.where(whole).select("*", F.lit(BEGIN).alias("enter"), F.lit(None).cast("int").alias("leave"))
    long = rows.where(~whole)
    if not long.isEmpty():
        states = ways(long, model, fan).select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "enter", "leave")
        long = long.join(states, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
        short = short.unionByName(long.drop("c", "k"))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(inputs):
        found = [shared.value.piece(x["text"], x["enter"], x["leave"]) for x in inputs]
        return ([t for t, _ in found], [on for _, on in found], [len(t) - on for t, on in found],
                [render(t, on, x["enter"] != BEGIN, x["last"]) for x, (t, on) in zip(inputs, found)])

    return map_text(short.select("conv_id", "chunk", "last", "roles", F.struct("text", "enter", "leave", "last").alias("piece")),
                    run, f"turns {TURNS}, goes_on boolean, n_turns int, rendered string", "piece",
                    ["conv_id", "chunk", "last", "roles"])


def query(spark, sf_dir: str) -> DataFrame:
    """All conversations as transcripts, parsed back; ``roles_match`` tells
    whether the recovered roles are the given ones."""
    rows = transcripts(table(spark, sf_dir, "conversations"))
    model = learn(rows.where(~held_out(F.col("conv_id"))))
    found = format_conversations(rows, model)
    return found.select("conv_id", "chunk", "last", held_out(F.col("conv_id")).alias("held_out"), "n_turns",
                        (~F.col("goes_on") & (F.col("turns.role") == F.col("roles"))).alias("roles_match"),
                        F.sha2("rendered", 256).alias("rendered_sha256"), "rendered")
