"""Pixel work on decoded images: channel order, shape check, augmentation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.operators.ranking import seeded_hash

# The image shape training expects and the augmentation ranges.
SHAPE = (224, 224, 3)
# Shifts reach a tenth of the size, light a fifth of the levels, contrast 200 in a thousand.
LIGHT = 51
CONTRAST = 200


def to_rgb(images: DataFrame) -> DataFrame:
    """Replace ``data`` (gray, BGR or BGRA) by ``image`` in RGB order, three channels.

    A row that could not be decoded (no channels) gets no image.
    """
    others = [f for f in images.schema.fields if f.name not in ("data", "n_channels")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pixels = pd.Series(index=batch.index, dtype=object)
            # images of one number of channels and bytes are reordered together
            there = batch[batch["n_channels"] > 0]
            for (channels, _), same in there.groupby([there["n_channels"], there["data"].map(len)]):
                flat = np.frombuffer(b"".join(same["data"]), np.uint8).reshape(len(same), -1, channels)
                ordered = np.repeat(flat, 3, axis=2) if channels == 1 else flat[:, :, 2::-1]
                pixels[same.index] = [image.tobytes() for image in ordered]
            out = batch.drop(columns=["data", "n_channels"])
            known = pd.Series(3, index=batch.index, dtype="Int32").where(batch["n_channels"] > 0)
            yield out.assign(n_channels=known, image=pixels.where(known.notna(), None))

    return images.mapInPandas(convert, f"{schema}, n_channels int, image binary")


def has_shape(shape: tuple[int, int, int] = SHAPE):
    height, width, channels = shape
    return F.coalesce(
        (F.col("height") == height)
        & (F.col("width") == width)
        & (F.col("n_channels") == channels)
        & (F.octet_length("image") == height * width * channels),
        F.lit(False),
    )


def split_by_shape(images: DataFrame, shape: tuple[int, int, int] = SHAPE):
    """Images of the wanted shape, and the rest with a reason."""
    ok = has_shape(shape)
    return images.filter(ok), images.filter(~ok).withColumn("reason", F.lit("bad_shape"))


def augment(images: DataFrame, key: str, seed: int) -> DataFrame:
    """Seeded flip, shift, brightness and contrast per image.

    The parameters are digits of a hash of seed and row key, and all arithmetic
    is in whole numbers, so a row looks the same whatever task, retry or engine
    handles it.
    """
    rows = images.withColumn("digits_", seeded_hash(F.col(key), seed))
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema.fields
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["image"] = [
                _augment(i, h, w, c, d)
                for i, h, w, c, d in zip(
                    batch["image"], batch["height"], batch["width"], batch["n_channels"], batch["digits_"]
                )
            ]
            yield batch.drop(columns=["digits_"])

    return rows.mapInPandas(run, schema)


def _augment(image: bytes, height: int, width: int, channels: int, digits: str) -> bytes:
    # five numbers from 0 to 65,535, each spread over its range
    flip, down, right, light, contrast = (int(digits[4 * i : 4 * i + 4], 16) for i in range(5))
    rows, columns = (
        _shifted(size, draw * (2 * _reach(size) + 1) // 65536 - _reach(size))
        for size, draw in ((height, down), (width, right))
    )
    if flip < 32768:
        columns = columns[::-1]
    flat = np.frombuffer(image, dtype=np.uint8).reshape(height, width, channels)
    pixels = flat[rows][:, columns].reshape(-1, channels)
    # Light and contrast map each of the 256 levels of a channel to one level.
    levels = np.clip(np.arange(256) + light * (2 * LIGHT + 1) // 65536 - LIGHT, 0, 255)
    stretch = contrast * (2 * CONTRAST + 1) // 65536 + 1000 - CONTRAST
    out = np.empty_like(pixels)
    for c in range(channels):
        mean = int(np.bincount(pixels[:, c], minlength=256) @ levels) // len(pixels)
        table = np.clip(((levels - mean) * stretch + 500) // 1000 + mean, 0, 255).astype(np.uint8)
        out[:, c] = table[pixels[:, c]]
    return out.tobytes()


def _reach(size: int) -> int:
    """Longest shift: a tenth of the size, rounded."""
    return (size + 5) // 10


def _shifted(size: int, by: int) -> np.ndarray:
    """Source index of every place after a shift; the gap mirrors the edge."""
    index = np.arange(size) - by
    index = np.where(index < 0, -index - 1, index)
    return np.where(index >= size, 2 * size - 1 - index, index)
