"""Reading vector columns inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lengths, entries) of a list column: places of the rows that aren't null and hold finite entries only, their lengths,
    and their entries, as doubles, end to end."""
    length = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length >= 0)
    length = length[rows].astype(np.int64)
    entries = column.flatten()  # null rows have none
    given = pa.compute.is_valid(entries).to_numpy(zero_copy_only=False)
    entries = entries.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate(([0], np.cumsum(~(given & np.isfinite(entries)))))
    end = np.cumsum(length)
    good = bad[end] == bad[end - length]
    return rows[good], length[good], entries[np.repeat(good, length)]


def by_length(rows: np.ndarray, lengths: np.ndarray, entries: np.ndarray):
    """(rows, matrix) for each length above 0."""
    end = np.cumsum(lengths)
    for n in np.unique(lengths[lengths > 0]):
        some = lengths == n
        yield rows[some], entries[((end - lengths)[some][:, None] + np.arange(n)).ravel()].reshape(-1, n)
