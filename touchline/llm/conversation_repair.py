"""Repair of the role structure of conversations, by a suffix-shared automaton of their signatures.

Every row is a letter: the initial of its role (s, u, a, or another) and its first fault (none,
truncated, blank, duplicate). The letters of a conversation are its signature. Repairing costs:
keeping a row nothing, giving it the role of a user or assistant 3, deleting it 4, inserting an empty
message of a user or assistant 3, leaving a truncated row in 3; blank and duplicate rows must go. The
roles that are left must read (s?(ua)+)?, by initials. Of the cheapest ways the one counts whose
edits' initials (D, I, K, R) come first in ASCII order.

What the rest of a conversation costs depends on its remaining letters and on the last role that was
put out (the grammar state), so the work is done from the end, once for all conversations: signatures
are made distinct, sorted by their letters from the end, and each task walks its range of that order as
a directed word graph, minimised from the end: a signature begins where it leaves the one before it, and
nodes of the same costs are one. Each node holds, by grammar state, its cost-to-go and the edits up to
the next node; a state's candidates begin with different initials, so a node decides ties alone. The
audit is read off along the path.

Rows are sorted once, by ranges of conversation, turn, role and text, so a conversation of any length
is spread over tasks and cut into pieces of at most PIECE_ROWS rows or PIECE_BYTES of text. A
conversation that lies within one task and piece is finished there; for the others copies of a row are
searched over all pieces by digest, the letters (one byte a row, as in the audit) are put together, and
the edits go back to the pieces. Only the digest of such a conversation needs its pieces in order; they
stream through one task.

Nulls: a null role or text is one space (so such a text is blank), a null turn comes first and is
ignored in gaps, rows with a null conv_id are one conversation, and null ids are one space where the
damage of a row is drawn. Rows of one turn are in the order of their role and text. A role that begins
with s, u or a counts as such; an empty one as another. Repeated rows are duplicates. A conversation
without rows after the damage has zeros, an empty audit and the digest of an empty text; an empty
table gives no rows. Extra columns are ignored.
"""

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.session import settle

SPACE = " \t\n\x0b\x0c\r"
PIECE_ROWS = 4_096
PIECE_BYTES = 1 << 20
#: Text that one task of the sorted order gets, about.
RANGE_BYTES = 64 << 20
#: Audits are broadcast if they are no larger than this, else the FREQUENT most used ones are.
BROADCAST_BYTES = 16 << 20
FREQUENT = 1_000

RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INITIALS = "sua"
FAULTS = ("", "truncated", "blank", "duplicate")
FIGURES = ("blank", "duplicate", "truncated", "illegal", "cost")

# Grammar states: nothing put out yet, a system message, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
#: What an inserted or relabelled message must be in a state, and the state after it.
_NEXT = {q: ("assistant", ASSISTANT) if q == USER else ("user", USER) for q in range(4)}
#: Costs and edits at the end of a conversation, by state.
_END = ((0, 2 * INSERT, INSERT, 0), ("", "II", "I", ""))


def letter(initial: str, fault: int) -> str:
    return chr(65 + 4 * (INITIALS.find(initial) if initial in ("s", "u", "a") else 3) + fault)


def parts_of(code: str) -> tuple[str, int]:
    """The initial and the fault of a letter."""
    number = ord(code) - 65
    return ("s", "u", "a", "")[number // 4], number % 4


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the damaged rows; rows that were dropped are left, not `live`."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    ids = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = rows.withColumn("kind", F.crc32(F.concat(ids[0], F.lit(":"), ids[1])) % 20)
    kind = F.col("kind")
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind != 0).alias("live"), "kind")
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", "role", "text", "live", copies.alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with their letters (duplicates not yet known), in ranges of the order of all rows."""
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("role"))).first()[0] or 0
    n = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(end == "", 2).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12) + fault
    rows = rows.select("conv_id", "turn", "role", "text", "live", F.char(code + 65).alias("letter"))
    first = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    # Beginnings of texts sort as texts do and keep the samples of the ranges small.
    ranged = rows.repartitionByRange(n, *first, F.substring("role", 1, 16), F.substring("text", 1, 32))
    return ranged.sortWithinPartitions(*first, "role", "text")


_PIECES = (
    "conv_id long, part int, seg int, open boolean, letters string, keys binary, roles array<string>, texts array<string>, "
    "first_turn long, last_turn long, n_turns long"
)
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 3]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], types, schema: str) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _names(schema))


def _digest(role: str, text: str) -> bytes:
    role_bytes = role.encode()
    return hashlib.blake2b(len(role_bytes).to_bytes(8, "little") + role_bytes + text.encode(), digest_size=16).digest()


def cut_pieces(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """A row per piece of a conversation. Pieces are `open` if the conversation may have others.

    keys: digests of the piece's rows that are neither blank nor copies of an earlier one in the task.
    """

    def run(batches):
        part, seg, first, done = TaskContext.get().partitionId(), 0, True, []
        none = object()
        now, seen, several = none, set(), False
        letters, keys, roles, texts, turns, size = [], [], [], [], [], 0

        def piece(open_: bool) -> tuple:
            numbers = [t for t in turns if t is not None]
            out = (now, part, seg, open_, "".join(letters), b"".join(keys), roles.copy(), texts.copy(), numbers[0] if numbers else None, numbers[-1] if numbers else None, len(set(numbers)))
            for kept in (letters, keys, roles, texts, turns):
                kept.clear()
            return out

        for batch in batches:
            for conv_id, turn, role, text, live, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv_id != now:
                    if now is not none:
                        done.append(piece(first or several))
                        seg, first, several, size = seg + 1, False, False, 0
                        seen.clear()
                    now = conv_id
                if not live:
                    continue
                if len(letters) >= piece_rows or (letters and size >= piece_bytes):
                    several = True
                    done.append(piece(True))
                    seg, size = seg + 1, 0
                initial, fault = parts_of(code)
                if fault < 2:
                    key = _digest(role, text)
                    if key in seen:
                        code = letter(initial, 3)
                    else:
                        seen.add(key)
                        keys.append(key)
                letters.append(code)
                roles.append(role)
                texts.append(text)
                turns.append(turn)
                size += len(text)
            if done:
                yield _batch(done, _TYPES, _PIECES)
                done = []
        if now is not none:
            yield _batch([piece(True)], _TYPES, _PIECES)

    return rows.mapInArrow(run, _PIECES)


def _known_copies(open_pieces: DataFrame) -> DataFrame:
    """part, seg and letters of open pieces, with the rows that copy a row of an earlier piece marked."""

    def spread(batches):
        for batch in batches:
            for conv_id, part, seg, letters, keys in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "seg", "letters", "keys")), strict=True):
                places = [i for i, c in enumerate(letters) if (ord(c) - 65) % 4 < 2]
                yield _batch([(conv_id, part, seg, i, keys[16 * k : 16 * k + 16]) for k, i in enumerate(places)], kinds, schema)

    schema, kinds = "conv_id long, part int, seg int, place int, key binary", [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    spread_keys = open_pieces.select("conv_id", "part", "seg", "letters", "keys").mapInArrow(spread, schema)
    # A key is once in each piece, so a group is as long as a conversation has pieces.
    order = W.partitionBy("conv_id", "key").orderBy("part", "seg")
    copies = spread_keys.withColumn("n", F.row_number().over(order)).filter("n > 1").groupBy("part", "seg").agg(F.collect_list("place").alias("places"))
    marked = F.transform(F.split("letters", ""), lambda c, i: F.when(F.array_contains("places", i), F.translate(c, "ABEFIJMN", "DDHHLLPP")).otherwise(c))
    letters = F.when(F.col("places").isNull(), F.col("letters")).otherwise(F.array_join(marked, ""))
    rows = open_pieces.select("conv_id", "part", "seg", "letters", "first_turn", "last_turn", "n_turns").join(copies, ["part", "seg"], "left")
    return rows.withColumn("letters", letters).drop("places")


class Nodes:
    """Nodes of the word graph: by letter and the costs of the node after it, up to a constant.

    A node is (costs by state, less their least; that least, less the next node's; edits and state
    after them, by state). Costs differ by a few edits at most, so there are few nodes.
    """

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def node(self, code: str, after: tuple[int, ...]) -> tuple:
        found = self.known.get((code, after))
        if found is None:
            found = self.known[code, after] = self._decided(*parts_of(code), after)
        return found

    @staticmethod
    def _decided(initial: str, fault: int, after: tuple[int, ...]) -> tuple:
        best = []
        for q in range(4):
            ways = [(DELETE + after[q], "D", q)]
            if fault < 2:
                left_in = TRUNCATED if fault == 1 else 0
                to = _AFTER.get((q, initial))
                if to is not None:
                    ways.append((left_in + after[to], "K", to))
                to = _NEXT[q][1]
                ways.append((left_in + RELABEL + after[to], "R", to))
            best.append(min(ways))
        # Inserting stays at the node. Two passes reach all: a third insertion is never cheaper.
        for _ in range(2):
            inserted = [(INSERT + best[to][0], "I" + best[to][1], best[to][2]) for _, to in (_NEXT[q] for q in range(4))]
            best = [min(pair) for pair in zip(best, inserted, strict=True)]
        least = min(cost for cost, _, _ in best)
        return tuple(cost - least for cost, _, _ in best), least, tuple((edits, to) for _, edits, to in best)


_AUDITS = "letters string, uses long, audit string, blank long, duplicate long, truncated long, illegal long, cost long"


def audits(signatures: DataFrame) -> DataFrame:
    """Counts, cost and audit of signatures(letters, uses), each of which is there once."""

    def run(batches):
        nodes, path, last = Nodes(), [((_END[0]), 0, None)], ""  # costs, least so far, edits: from the end
        for batch in batches:
            out = []
            for backward, uses in zip(batch["backward"].to_pylist(), batch["uses"].to_pylist(), strict=True):
                shared = next((i for i, (x, y) in enumerate(zip(backward, last, strict=False)) if x != y), min(len(backward), len(last)))
                del path[shared + 1 :]
                for code in backward[shared:]:
                    costs, least, _ = path[-1]
                    found = nodes.node(code, costs)
                    path.append((found[0], least + found[1], found[2]))
                last, edits, state = backward, [], START
                for _, _, ways in reversed(path[1:]):
                    way, state = ways[state]
                    edits.append(way)
                edits.append(_END[1][state])
                letters = backward[::-1]
                faults = [sum(letters.count(chr(65 + 4 * i + f)) for i in range(4)) for f in (2, 3, 1)]
                initials = [("s", "u", "a", "-")[(ord(c) - 65) // 4] for c in letters]
                illegal = sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:], strict=False))
                out.append((letters, uses, "".join(edits), *faults, illegal, path[-1][1] + path[-1][0][START]))
            yield _batch(out, [pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 5], _AUDITS)

    backward = signatures.select(F.reverse("letters").alias("backward"), "uses")
    return backward.repartitionByRange(F.substring("backward", 1, 64)).sortWithinPartitions("backward").mapInArrow(run, _AUDITS)


def _with_audits(conversations: DataFrame, known: DataFrame, small: bool) -> DataFrame:
    """Joined on letters. No signature that isn't broadcast makes more than 1/FREQUENT of the rows."""
    if small:
        return conversations.join(F.broadcast(known.drop("uses")), "letters")  # checked: BROADCAST_BYTES
    frequent = known.filter(F.length("letters") <= PIECE_ROWS).orderBy(F.desc("uses"), "letters").limit(FREQUENT).drop("uses")
    common = conversations.join(F.broadcast(frequent), "letters")  # FREQUENT rows of at most PIECE_ROWS letters
    rare = conversations.join(F.broadcast(frequent.select("letters")), "letters", "left_anti").join(known.drop("uses"), "letters")
    return common.unionByName(rare)


def repaired_messages(roles: list[str], texts: list[str], edits: str, state: int = START) -> list[tuple[str, str]]:
    """The rows that the edits leave, as (role, text)."""
    out, rows = [], zip(roles, texts, strict=True)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = _AFTER[state, role[:1]]
        else:
            role, state = _NEXT[state]
        out.append((role, text))
    return out


def state_after(letters: str, edits: str, state: int) -> int:
    rows = iter(letters)
    for edit in edits:
        code = "" if edit == "I" else next(rows)
        if edit == "K":
            state = _AFTER[state, parts_of(code)[0]]
        elif edit in "IR":
            state = _NEXT[state][1]
    return state


_SLICES = "part int, seg int, piece int, n_pieces int, state int, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _slices(conversations: DataFrame) -> DataFrame:
    """The edits of each piece of a conversation, with the state before them; and its figures."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                audit, at, state, out = row["audit"], 0, START, []
                turned = [r for r in row["runs"] if r["first_turn"] is not None]
                distinct = sum(r["n_turns"] for r in turned) - sum(x["last_turn"] == y["first_turn"] for x, y in zip(turned, turned[1:], strict=False))
                gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - distinct if turned else 0
                for k, r in enumerate(row["runs"]):
                    begin, left = at, len(r["letters"])
                    last = k == len(row["runs"]) - 1
                    while at < len(audit) and (last or left):
                        left -= audit[at] != "I"
                        at += 1
                    edits = audit[begin:at]
                    out.append((r["part"], r["seg"], k, len(row["runs"]), state, edits, gaps, *(row[f] for f in FIGURES)))
                    state = state_after(r["letters"], edits, state)
                yield _batch(out, [*[pa.int32()] * 5, pa.string(), *[pa.int64()] * 6], _SLICES)

    return conversations.mapInArrow(run, _SLICES)


REPAIRED = "conv_id long, piece int, n_pieces int, edits string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, messages array<struct<role: string, text: string>>"


def _applied(pieces: DataFrame) -> DataFrame:
    kept = _names(REPAIRED.split(", messages")[0])
    message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("roles", "texts", "edits", "state")), strict=True)
            left = [[{"role": r, "text": t} for r, t in repaired_messages(*row)] for row in rows]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(left, message)], [*kept, "messages"])

    return pieces.select(*kept, "roles", "texts", "state").mapInArrow(run, REPAIRED)


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Repaired conversations of rows(conv_id, turn, role, text, live), as damage() returns them.

    A row per piece: the messages that are left, the edits that led there, and the figures of the
    whole conversation. Most conversations are one piece; the edits of all pieces are the audit.
    """
    pieces = settle(cut_pieces(ordered(rows), piece_rows, piece_bytes))
    closed, opened = pieces.filter(~F.col("open")), pieces.filter("open")
    run = F.struct("part", "seg", "letters", "first_turn", "last_turn", "n_turns")
    joined = _known_copies(opened).groupBy("conv_id").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    joined = settle(joined.withColumn("letters", F.array_join(F.col("runs.letters"), "")))
    signatures = closed.select("letters").unionByName(joined.select("letters")).groupBy("letters").agg(F.count("*").alias("uses"))
    known = settle(audits(settle(signatures)))
    size = known.agg(F.sum(F.length("letters") + F.length("audit") + 48)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    whole = _with_audits(closed, known, small).select(
        "conv_id", F.lit(0).alias("piece"), F.lit(1).alias("n_pieces"), F.col("audit").alias("edits"),
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps"),
        *FIGURES, "roles", "texts", F.lit(START).alias("state"),
    )
    slices = _slices(_with_audits(joined, known, small))
    cut = opened.select("conv_id", "part", "seg", "roles", "texts").join(slices, ["part", "seg"]).select(whole.columns)
    return _applied(whole.unionByName(cut))


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its figures, its audit, and the digest of its messages."""
    figures = ["conv_id", "gaps", *FIGURES]
    text = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    rows = repaired.select(*figures, "piece", "n_pieces", "edits", F.size("messages").alias("n"), text.alias("text"))
    single = rows.filter("n_pieces = 1").select(*figures, F.col("edits").alias("audit"), F.sha2("text", 256).alias("repaired_sha256"))
    several = rows.filter("n_pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["piece"] == 0:
                    audit, digest, begun = [], hashlib.sha256(), False
                audit.append(row["edits"])
                if row["n"]:
                    digest.update(("\n" if begun else "").encode() + row["text"].encode())
                    begun = True
                if row["piece"] == row["n_pieces"] - 1:
                    out.append((*(row[f] for f in figures), "".join(audit), digest.hexdigest()))
            yield _batch(out, [*[pa.int64()] * 7, pa.string(), pa.string()], RESULT)

    return single.unionByName(several.mapInArrow(run, RESULT))
