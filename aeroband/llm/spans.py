"""Taking spans of bytes out of documents."""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(spans: list[tuple[int, int]], least: int = 0) -> list[tuple[int, int]]:
    """Maximal runs of the spans (start, end), of at least ``least`` bytes, in order."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return [run for run in runs if run[1] - run[0] >= least]


def kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for run in runs for edge in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def cut(docs: DataFrame, spans: DataFrame, keys: list[str], least: int = 0, with_text: bool = False) -> DataFrame:
    """A row per document with its size, the bytes and runs removed, and the hash of the rest (and the rest itself).

    ``docs`` has ``doc_id``, ``text`` and ``keys``; ``spans`` has ``keys``, ``start`` and ``end``, in any number, order
    and overlap. The spans of one text are gathered, which its length bounds; equal ones are merged before the exchange.
    """
    gathered = spans.groupBy(*keys).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.join(gathered, keys, "left").select("doc_id", "text", "spans")
    schema = REPORT + (", kept binary" if with_text else "")

    def run(batches):
        for batch in batches:
            out = []
            texts, found = batch.column("text").cast(pa.binary()), batch.column("spans")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                data = texts[i].as_py() or b""
                runs = merged([(s["start"], s["end"]) for s in found[i].as_py() or ()], least)
                rest = kept(data, runs)
                row = doc_id, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()
                out.append(row + (rest,) if with_text else row)
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            columns = zip(*out) if out else [()] * (5 + with_text)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_text]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    return rows.mapInArrow(run, schema)
