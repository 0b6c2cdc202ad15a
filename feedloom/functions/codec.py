"""Vectors of 32-bit floats to bytes and back.

Spark has no cast between a float array and binary. Both directions re-label the Arrow
buffers of a whole batch; there is no work per row or per element.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, FloatType

FLOAT_BYTES = 4


@arrow_udf(BinaryType())
def pack_vector(vectors: pa.Array) -> pa.Array:
    """float32 list -> its little-endian bytes."""
    values = vectors.flatten()
    if values.null_count:
        raise ValueError("a vector holds a null element")
    data = np.ascontiguousarray(values.to_numpy(zero_copy_only=False), dtype="<f4")
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes * FLOAT_BYTES)]).astype(np.int32)
    buffers = [vectors.is_valid().buffers()[1], pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(vectors), buffers)


@arrow_udf(ArrayType(FloatType()))
def unpack_vector(blobs: pa.Array) -> pa.Array:
    """Bytes -> float32 list; null if the length is no multiple of four."""
    sizes = pc.fill_null(pc.binary_length(blobs), -1).to_numpy(zero_copy_only=False)
    good = (sizes >= 0) & (sizes % FLOAT_BYTES == 0)
    joined = b"".join(blobs.filter(pa.array(good)).to_pylist())
    offsets = np.concatenate([[0], np.cumsum(np.where(good, sizes // FLOAT_BYTES, 0))])
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)),
        pa.array(np.frombuffer(joined, dtype="<f4")),
        mask=pa.array(~good),
    )
