"""Cross-tokenizer alignment: covering tokens by as-of merges.

A batch's texts lie one after the other on a scale of bytes.  ``pandas.merge_asof``,
keyed by document, gives each token of one tokenizer the other's token that covers its first
byte; the union of both directions is every overlap.  Where a token begins together with
the one that covers it, both sides' tokens before it end together, so a group begins.
All pairs of tokens of one group are linked.

How many documents link a pair of ids is asked of the corpus: a batch sends its distinct
pairs, with the number of its documents that hold each, to the bucket of the pair's
first id; the bucket adds them up, knows the highest of each first id, and answers each
batch in the order asked.  A pair that a third of all rows hold is one entry per batch.
What a document needs for its sums is kept with the batch until the answers come.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import (bucket_of, chunk_count, edges_of, mix, pack_bits, portions, squeeze, unpack_bits,
                     unsqueeze)
from .tokens import ByteTokens, PieceTokens

#: Bytes of text aligned at once (a longer text goes alone), and pairs listed at once.
BATCH_BYTES, PAIRS = 3 << 20, 4 << 20
#: Bucket of the row that holds a batch's documents.
_BODY = -1


def tokens_of(coded: list[np.ndarray], size: np.ndarray, use: np.ndarray) -> pd.DataFrame:
    """All tokens of the used texts: ``doc`` (index of the text), ``id``, ``start`` on the batch's scale
    of bytes, and ``at`` (the token's number)."""
    n = np.array([len(c) for c in coded], np.int64)
    n[~use] = 0
    id_ = np.concatenate([c for c, u in zip(coded, use.tolist()) if u] or [np.empty(0, np.uint32)]).astype(np.int64)
    length = size[id_]
    return pd.DataFrame({"doc": np.repeat(np.arange(len(coded)), n), "id": id_,
                         "start": np.cumsum(length) - length, "at": np.arange(len(id_))})


def groups_of(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The number of each token's group, on both sides; groups are in the order of the text."""
    over_a = pd.merge_asof(a[["doc", "start"]], b[["doc", "start", "at"]].assign(other=b["start"]), on="start", by="doc")
    over_b = pd.merge_asof(b[["doc", "start"]], a[["doc", "start", "at"]], on="start", by="doc")
    group = np.cumsum((over_a["other"].to_numpy() == over_a["start"].to_numpy())) - 1
    return group, group[over_b["at"].to_numpy()]


def written(a: pd.DataFrame, b: pd.DataFrame, ga: np.ndarray, gb: np.ndarray, n: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each of ``n`` documents: its groups' ids in order."""
    groups = ga[-1] + 1 if len(ga) else 0
    last_a, last_b = np.append(ga[1:] != ga[:-1], True)[:len(ga)], np.append(gb[1:] != gb[:-1], True)[:len(gb)]
    doc_a, doc_b = a["doc"].to_numpy(), b["doc"].to_numpy()
    end = np.append(doc_b[1:] != doc_b[:-1], True)[:len(doc_b)]
    # a group's tokens of the first side, then of the second
    before_b = np.concatenate([[0], np.cumsum(np.bincount(gb, minlength=groups))])
    up_to_a = np.cumsum(np.bincount(ga, minlength=groups))
    code = np.empty(len(ga) + len(gb), np.int64)
    most = int(max(a["id"].max(), b["id"].max()) + 1) if len(a) else 0
    code[np.arange(len(ga)) + before_b[ga]] = a["id"].to_numpy() + most * last_a
    code[np.arange(len(gb)) + (up_to_a[gb] if groups else 0)] = b["id"].to_numpy() + most * (2 * last_b + end)
    names = [str(i) for i in range(most)]
    table = pa.array([x + sign for sign in (",", "|", ";", "") for x in names], pa.string())
    # ends of groups: 1 for the first side, 2 and 3 (of the document as well) for the second
    edges = np.searchsorted(doc_a, np.arange(n + 1)) + np.searchsorted(doc_b, np.arange(n + 1))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), table.take(pa.array(code))), "").to_pylist()


def linked(a: pd.DataFrame, b: pd.DataFrame, ga: np.ndarray, gb: np.ndarray, width: int):
    """Links by document: ``(doc, pair, times)`` with ``pair = a * width + b``, ascending and distinct."""
    groups = ga[-1] + 1 if len(ga) else 0
    count = np.bincount(gb, minlength=groups)
    first = np.cumsum(count) - count
    each = count[ga]  # links of each token of the first side
    stop = np.cumsum(each)
    ida, idb, doc = a["id"].to_numpy(), b["id"].to_numpy(), a["doc"].to_numpy()
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    space = (int(ida.max()) + 1) * width if len(ida) else 1

    def add(key: np.ndarray, n: np.ndarray | None) -> None:
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        keys.append(key[new])
        times.append(np.diff(new, append=len(key)) if n is None else np.add.reduceat(n[order], new) if len(new) else n)

    cuts = np.unique(np.searchsorted(stop, np.arange(PAIRS, (stop[-1] if len(stop) else 0) + PAIRS, PAIRS)))
    begin = 0
    for end in [min(c + 1, len(each)) for c in cuts.tolist()]:
        n = each[begin:end]
        edge = np.cumsum(n)
        other = np.arange(edge[-1] if len(edge) else 0) + np.repeat(first[ga[begin:end]] - (edge - n), n)
        add(np.repeat(doc[begin:end] * space + ida[begin:end] * width, n) + idb[other], None)
        begin = end
    if len(keys) > 2:
        key, n = np.concatenate(keys), np.concatenate(times)
        keys, times = [], []
        add(key, n)
    return keys[-1] // space, keys[-1] % space, times[-1]


def align(docs: DataFrame, byte_file: str, piece_file: bytes, id_col: str = "doc_id", text_col: str = "text",
          texts: bool = False) -> DataFrame:
    """Align the tokens of two tokenizers over each whole text.

    ``byte_file``, ``piece_file``: contents of a byte-level tokenizer file (A, reads a space and the
    text) and of a sentence-piece model (B, which adds the space by itself).  Strings of special
    tokens are text as any other.  Returns one row per input row: ``doc_id, n_a, n_b`` (tokens),
    ``n_groups``, ``n_links`` (token pairs of one group), ``n_best`` (links whose id pair is
    linked in the most documents among the pairs of its A id, ties included), ``count_sum`` (over
    links, in how many documents the link's id pair is linked), ``groups_sha256`` (lowercase hex
    of the groups as ``a1,a2|b1;a3|b2,b3``) and with ``texts`` the ``groups`` themselves.

    A text that is null or empty, or of which either side's tokens do not give back the bytes,
    has no tokens: zeros, and an empty string for both.  Rows with equal or null ids are documents
    each by itself.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"files": (byte_file, piece_file)})
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = chunk_count(docs, text_col)
    body = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
                      ("pairs", pa.int64())])

    def setup():
        # the process keeps its copy of what is broadcast from task to task, and the tokenizers with it
        box = shared.value
        if "sides" not in box:
            box["sides"] = ByteTokens(box["files"][0], plain_specials=True), PieceTokens(box["files"][1])
            box["sizes"] = [np.array(list(map(len, s.bytes)), np.int64) for s in box["sides"]]
        return box["sides"], box["sizes"]

    def exact(side, coded: np.ndarray, data: bytes) -> bool:
        return b"".join(map(side.bytes.__getitem__, coded.tolist())) == data

    def batch_rows(part: int, batch: pa.RecordBatch):
        (first, second), sizes = setup()
        given = [t or "" for t in batch.column(1).to_pylist()]
        led = [" " + t for t in given]
        coded_a, coded_b = first.encode(led), second.encode(given)
        data = [t.encode() for t in led]
        use = np.array([bool(t) and exact(first, x, d) and exact(second, y, d)
                        for t, x, y, d in zip(given, coded_a, coded_b, data)], bool)
        a, b = tokens_of(coded_a, sizes[0], use), tokens_of(coded_b, sizes[1], use)
        ga, gb = groups_of(a, b)
        n, doc = len(given), a["doc"].to_numpy()
        heads = np.append(True, ga[1:] != ga[:-1])[:len(ga)]
        per_a = np.bincount(gb, minlength=len(ga) and ga[-1] + 1)[ga]
        text = written(a, b, ga, gb, n)
        of, pair, times = linked(a, b, ga, gb, len(sizes[1]))
        # pairs of the batch by bucket of the first id, and in how many documents each is
        key, index = np.unique(pair, return_inverse=True)
        bucket = bucket_of(mix((key // len(sizes[1])).astype(np.uint64)), buckets)
        order = np.lexsort((key, bucket))
        key, edges = key[order], edges_of(bucket[order], buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[index].astype(np.uint32)
        held = np.bincount(place, minlength=len(key))
        table = pa.Table.from_arrays(
            [batch.column(0), pa.array(np.bincount(doc, minlength=n)),
             pa.array(np.bincount(b["doc"].to_numpy(), minlength=n)),
             pa.array(np.bincount(doc[heads], minlength=n)),
             pa.array(np.bincount(doc, weights=per_a, minlength=n).astype(np.int64)),
             pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text], pa.string()),
             pa.array(text if texts else [None] * n, pa.string()), pa.array(np.bincount(of, minlength=n))], schema=body)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, body, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        yield (part, _BODY, sink.getvalue().to_pybytes(), pa.compress(place.tobytes(), "zstd", asbytes=True),
               pa.compress(times.astype(np.uint32).tobytes(), "zstd", asbytes=True), len(place))
        for x in np.flatnonzero(np.diff(edges)).tolist():
            cut = slice(edges[x], edges[x + 1])
            yield part, x, squeeze(key[cut]), squeeze(held[cut]), None, int(edges[x + 1] - edges[x])

    made = pa.schema([("part", pa.int64()), ("bucket", pa.int32()), ("x", pa.binary()), ("y", pa.binary()),
                      ("z", pa.binary()), ("n", pa.int64())])

    def work(batches):
        part = TaskContext.get().partitionId() << 32
        for portion in chain.from_iterable(portions(b, 1, BATCH_BYTES) for b in batches):
            columns = zip(*batch_rows(part, portion))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, made)], schema=made)
            part += 1

    batches = cut_lineage(rows.mapInArrow(work, "part long, bucket int, x binary, y binary, z binary, n long"))
    width = shared_width(piece_file)

    def answer(table: pa.Table) -> pa.Table:
        sizes = table["n"].to_pylist()
        edges = np.cumsum([0, *sizes])
        key = np.concatenate([unsqueeze(x, n) for x, n in zip(table["x"].to_pylist(), sizes)])
        held = np.concatenate([unsqueeze(x, n) for x, n in zip(table["y"].to_pylist(), sizes)])
        distinct, index = np.unique(key, return_inverse=True)
        total = np.bincount(index, weights=held).astype(np.int64)
        first = distinct // width
        head = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        best = total == np.repeat(np.maximum.reduceat(total, head), np.diff(head, append=len(first)))
        said, top = total[index], best[index]
        return pa.table({
            "part": table["part"], "bucket": table["bucket"], "n": table["n"],
            "count": pa.array([squeeze(said[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()),
            "best": pa.array([pack_bits(top[a:b]) for a, b in zip(edges, edges[1:])], pa.binary())})

    answers = (batches.where(F.col("bucket") != _BODY).select("part", "bucket", "x", "y", "n").groupBy("bucket")
               .applyInArrow(answer, "part long, bucket int, n long, count binary, best binary"))

    def finish(bodies: pa.Table, said: pa.Table) -> pa.Table:
        said = said.sort_by("bucket")
        sizes = said["n"].to_pylist()
        count = np.concatenate([np.empty(0, np.int64), *(unsqueeze(x, n) for x, n in zip(said["count"].to_pylist(), sizes))])
        best = np.concatenate([np.empty(0, bool), *(unpack_bits(x, n) for x, n in zip(said["best"].to_pylist(), sizes))])
        packet, place, times, n = (bodies[c][0].as_py() for c in ("x", "y", "z", "n"))
        place = np.frombuffer(pa.decompress(place, 4 * n, "zstd", asbytes=True), np.uint32)
        times = np.frombuffer(pa.decompress(times, 4 * n, "zstd", asbytes=True), np.uint32).astype(np.int64)
        out = pa.ipc.open_stream(packet).read_all()
        edge = np.concatenate([[0], np.cumsum(out["pairs"].to_numpy())])

        def by_doc(values: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.concatenate([[0], np.cumsum(values)])[edge]))

        columns = {c: out[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        columns |= {"n_best": by_doc(times * best[place]), "count_sum": by_doc(times * count[place]),
                    "groups_sha256": out["groups_sha256"]}
        return pa.table(columns | ({"groups": pc.fill_null(out["groups"], "")} if texts else {}))

    return (batches.where(F.col("bucket") == _BODY).groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string" + (", groups string" if texts else "")))


def shared_width(piece_file: bytes) -> int:
    """Number of ids of the second tokenizer."""
    return len(PieceTokens(piece_file).bytes)
