"""Typed views over the stored images (the images are kept as JSON text so
later views can shape them)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_view(
    df: DataFrame,
    spec: dict[str, tuple[str, str]],
    image: str = "new_image",
    keep: tuple[str, ...] = ("keys",),
) -> DataFrame:
    """Columns cast out of an image: ``{name: (json path, SQL type)}``.

    Numbers are stored as JSON strings, so a numeric type casts their text
    (``"4.50"`` -> DECIMAL 4.50). A missing path or a bad value gives NULL.
    The image is parsed once per row.
    """
    parsed = df.withColumn("_image", F.try_parse_json(F.col(image)))
    cols = [F.col(c) for c in keep]
    cols += [F.try_variant_get(F.col("_image"), path, dtype).alias(name) for name, (path, dtype) in spec.items()]
    return parsed.select(*cols)
