"""Dropping the first lines of each file, which the line readers cannot do.

Files stay splittable: only the split that starts a file holds its head, and
its lines reach one task in order, so a count per file is all the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


_BLANK = bytes(range(33))


def drop_file_heads(lines: DataFrame, skip_rows: int, *, header: bool) -> DataFrame:
    """Drop ``skip_rows`` lines, and then the header line, of every file."""
    if skip_rows < 0:
        raise ValueError("skip_rows must not be negative")

    # What runs in tasks is local, so it travels with the job and executors need
    # no copy of this package.
    blank = _BLANK

    def keep(batch: pa.RecordBatch, heads: dict[str, list]) -> np.ndarray:
        meta = batch.column("fileMetadata")
        starts = pc.equal(pc.struct_field(meta, "file_block_start"), 0).to_numpy(zero_copy_only=False)
        kept = np.ones(batch.num_rows, dtype=bool)
        if not starts.any():
            return kept
        paths = pc.struct_field(meta, "file_path").dictionary_encode()
        codes = paths.indices.to_numpy(zero_copy_only=False)
        # As bytes: a head need not be valid text.
        values = batch.column("value").cast(pa.binary())
        for code, path in enumerate(paths.dictionary.to_pylist()):
            rows = np.flatnonzero(starts & (codes == code))
            if rows.size == 0:
                continue
            # [lines still to skip, header still to drop, file size, split length]
            first = meta[int(rows[0])].as_py()
            state = heads.setdefault(
                path, [skip_rows, header, first["file_size"], first["file_block_length"]]
            )
            n = min(state[0], rows.size)
            kept[rows[:n]] = False
            state[0] -= n
            for row in rows[n:]:
                if not state[1]:
                    break
                # The header is the first line left that is not blank.
                kept[row] = False
                state[1] = not (values[int(row)].as_py() or b"").strip(blank)
        return kept

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[str, list] = {}
        for batch in batches:
            yield batch.filter(pa.array(keep(batch, heads)))
        for path, (left, pending, size, length) in heads.items():
            if (left or pending) and size > length:
                raise ValueError(f"the head of {path} is longer than its first split")

    return lines.mapInArrow(drop, lines.schema)
