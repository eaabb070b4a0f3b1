"""Sets of 16-bit numbers as compressed bitmaps, many at a time in Arrow columns.

A bitmap of fewer than 4096 members is its sorted members in two bytes each; a fuller
one is 65,536 plain bits.  Either way it has at most 8192 bytes, and its length tells
which form it has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NUMBERS = 1 << 16
FULL_BYTES = NUMBERS // 8
LISTED = FULL_BYTES // 2


def packed(members: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """One bitmap per entry of ``sizes`` from all members, sorted within each bitmap."""
    members = members.astype("<u2", copy=False)
    ends = np.cumsum(sizes)
    full = np.flatnonzero(sizes >= LISTED)
    parts, at = [], 0
    for n in full:
        begin = ends[n] - sizes[n]
        bits = np.zeros(NUMBERS, np.uint8)
        bits[members[begin : ends[n]]] = 1
        parts += [members[at:begin].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
        at = ends[n]
    parts.append(members[at:].tobytes())
    lengths = 2 * sizes
    lengths[full] = FULL_BYTES
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(parts))])


def unpacked(bitmaps: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All members, bitmap after bitmap, and how many each bitmap has."""
    if not len(bitmaps):
        return np.empty(0, np.uint16), np.empty(0, np.int64)
    lengths = pc.binary_length(bitmaps).to_numpy(zero_copy_only=False).astype(np.int64)
    # what the offsets of a slice point at
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    sizes = lengths // 2
    parts, at = [], int(offsets[0])
    for n in np.flatnonzero(lengths == FULL_BYTES):
        begin, end = int(offsets[n]), int(offsets[n + 1])
        members = np.flatnonzero(np.unpackbits(data[begin:end], bitorder="little")).astype("<u2")
        parts += [data[at:begin].view("<u2"), members]
        sizes[n], at = len(members), end
    parts.append(data[at : int(offsets[-1])].view("<u2"))
    return np.concatenate(parts), sizes


def multiplicity_planes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Bitmaps of how often things occur in documents, one list of planes per thing.

    ``keys`` are ``thing << 16 | document``, sorted and distinct.  A document is in plane
    ``k`` of a thing if bit ``k`` of its count is set, so the OR of the planes are the
    thing's documents and the planes' sizes, doubled from plane to plane, its total.
    """
    things, documents = keys >> 16, keys & (NUMBERS - 1)
    starts = np.flatnonzero(np.concatenate([[True], things[1:] != things[:-1]])) if len(keys) else np.empty(0, np.int64)
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
    most = np.maximum.reduceat(counts, starts) if len(starts) else np.empty(0, np.int64)
    depth = np.frexp(most)[1].astype(np.int64)
    planes = int(depth.max(initial=1))
    places = [np.flatnonzero(counts >> k & 1) for k in range(planes)]
    slots = np.concatenate([of[p] * planes + k for k, p in enumerate(places)])
    order = np.argsort(slots, kind="stable")
    sizes = np.bincount(slots, minlength=len(starts) * planes).reshape(-1, planes)
    wanted = np.arange(planes) < depth[:, None]
    values = packed(documents[np.concatenate(places)[order]], sizes[wanted].astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(depth)]).astype(np.int32)
    return things[starts], pa.ListArray.from_arrays(pa.array(offsets), values)


def read_planes(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, member and weight (2 to the plane) of every bit of a column of planes."""
    depth = pc.list_value_length(planes).to_numpy(zero_copy_only=False).astype(np.int64)
    members, sizes = unpacked(planes.flatten())
    row = np.repeat(np.arange(len(planes)), depth)
    plane = np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)
    return np.repeat(row, sizes), members, np.repeat(np.int64(1) << plane, sizes)


def document_counts(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Popcount of the OR of each row's planes, and the total that the planes add up to."""
    rows, members, weights = read_planes(planes)
    totals = np.zeros(len(planes), np.int64)
    np.add.at(totals, rows, weights)
    distinct = np.unique(rows * NUMBERS + members)
    return np.bincount(distinct >> 16, minlength=len(planes)), totals
