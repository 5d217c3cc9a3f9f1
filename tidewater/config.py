"""Job parameters as frozen dataclasses, checked when they are built."""

from __future__ import annotations

from dataclasses import dataclass, field


def split_key_names(text: str) -> tuple[str, ...]:
    """Comma-separated key names, trimmed, empties dropped; order is kept."""
    return tuple(part.strip() for part in text.split(",") if part.strip())


def _require(**values) -> None:
    missing = sorted(name for name, value in values.items() if value is None or value == "" or value == ())
    if missing:
        raise ValueError(f"missing required parameters: {', '.join(missing)}")


@dataclass(frozen=True)
class DecodeOptions:
    """How typed attribute values are turned into JSON text.

    max_depth     -- nesting levels decoded by the native expression; deeper
                     values go to ``deep_fallback``.
    deep_fallback -- "route" (default): in the jobs, which stage each batch,
                     rows are decoded natively; the flagged ones are staged
                     apart, decoded again from their raw text, and the batch
                     is ranked again, so no other row leaves the JVM.
                     Without a staging step ("udf" always): an Arrow UDF in
                     the plan decodes flagged values before rows are ranked.
                     Both give the same rows at any depth. "repair": rows
                     stay flagged (with keys and timestamp) for a caller
                     that passes a ``repair`` step to the upsert.
                     "error": error rows.
    strict_types  -- binary values and sets become error rows (as the
                     original per-row decoder did) instead of text/arrays.
    allow_empty_keys -- a change without ``Keys`` gets keys ``{}`` instead of
                     becoming an error row.
    """

    max_depth: int = 8
    deep_fallback: str = "route"
    strict_types: bool = False
    allow_empty_keys: bool = False

    def __post_init__(self):
        if not 1 <= self.max_depth <= 64:
            raise ValueError("max_depth must be between 1 and 64")
        if self.deep_fallback not in ("route", "repair", "udf", "error"):
            raise ValueError("deep_fallback must be 'route', 'repair', 'udf' or 'error'")


@dataclass(frozen=True)
class TargetConfig:
    """Where the latest-row-per-key table lives.

    path         -- shared directory of the Parquet target (bucket=<n> folders).
    buckets      -- number of hash buckets of ``keys``; a batch rewrites only
                    the buckets it touches.
    with_lookup  -- the target carries the two lookup columns.
    order_guard  -- keep the stored row when it is newer than the incoming one.
    check_unique -- fail a batch that holds two rows for one key.
    layout       -- "buckets": every batch rewrites the buckets it touches,
                    so readers find plain files; "deltas": a batch writes
                    its own rows only, readers merge them with the base,
                    ``compact`` folds them into a new base.
    compact_ratio -- (deltas) compact after a batch once the deltas hold at
                    least this share of the base's bytes, so that rewriting
                    stays in proportion to what was written; None: only
                    when ``compact`` is called.
    """

    path: str | None = None
    buckets: int = 64
    with_lookup: bool = False
    order_guard: bool = False
    check_unique: bool = True
    layout: str = "buckets"
    compact_ratio: float | None = None

    def __post_init__(self):
        if not self.path:
            raise ValueError("target needs a path")
        if self.buckets < 1:
            raise ValueError("buckets must be positive")
        if self.layout not in ("buckets", "deltas"):
            raise ValueError("layout must be 'buckets' or 'deltas'")
        if self.compact_ratio is not None and (self.layout != "deltas" or self.compact_ratio <= 0):
            raise ValueError("compact_ratio must be positive and needs layout='deltas'")


@dataclass(frozen=True)
class LookupConfig:
    """Join each record to the JSON file its ``s3_uri`` attribute names.

    path      -- file or directory of JSON files (read again every batch), or
                 of a Parquet table with ``s3_uri, raw_s3_payload`` columns.
    format    -- "json": JSON-lines files, the URI is the file's name;
                 "parquet": a lookup table, read whole every batch (no
                 listing of every file); "partitioned": one made by
                 ``prepare_lookup``, of which a batch reads only the
                 partitions its URIs name (the choice for a large store).
    verbatim  -- keep each line's text as is instead of re-serialising it.
    multi     -- "rows": one output row per lookup record (fan-out);
                 "array": all records of a file packed into one JSON array.
    follow    -- ("partitioned") folder of JSON-lines files, each written
                 once: before each batch the jobs add the files that came
                 since the last one to the prepared lookup at ``path``
                 (``sources/lookup.py: follow_files``).
    parts     -- partitions of a followed lookup, when it is made.
    broadcast -- hint the lookup side as broadcast, but only while the
                 lookup's files add up to at most ``broadcast_limit_bytes``
                 (checked every batch from the file system); above that,
                 and without the flag, AQE decides by measured size.
    """

    path: str
    format: str = "json"
    verbatim: bool = False
    multi: str = "rows"
    follow: str | None = None
    parts: int = 256
    broadcast: bool = False
    broadcast_limit_bytes: int = 64 * 1024 * 1024

    def __post_init__(self):
        _require(path=self.path)
        if self.format not in ("json", "parquet", "partitioned"):
            raise ValueError("format must be 'json', 'parquet' or 'partitioned'")
        if self.multi not in ("rows", "array"):
            raise ValueError("multi must be 'rows' or 'array'")
        if self.follow is not None and self.format != "partitioned":
            raise ValueError("follow needs format='partitioned'")
        if self.parts < 1:
            raise ValueError("parts must be positive")


def _check_outputs(target: TargetConfig | None, change_log: str | None, lookup: LookupConfig | None) -> None:
    if target is None and not change_log:
        raise ValueError("a job needs a target, a change_log path or both")
    if lookup is not None and (target is None or not target.with_lookup):
        raise ValueError("a lookup join needs a target with the lookup columns (with_lookup=True)")


@dataclass(frozen=True)
class StreamConfig:
    """Parameters of the streaming job.

    change_log -- folder that every batch's decoded changes are added to
                  (all of them, not the latest per key only); with
                  ``target=None`` it is the job's only output.
    """

    source_format: str
    target: TargetConfig | None
    checkpoint_location: str
    source_options: dict = field(default_factory=dict)
    source_path: str | None = None
    source_column: str | None = None
    trigger_interval: str | None = "100 seconds"
    available_now: bool = False
    lookup: LookupConfig | None = None
    decode: DecodeOptions = field(default_factory=DecodeOptions)
    collapse_errors: bool = False
    query_name: str | None = None
    change_log: str | None = None

    def __post_init__(self):
        _require(source_format=self.source_format, checkpoint_location=self.checkpoint_location)
        _check_outputs(self.target, self.change_log, self.lookup)


@dataclass(frozen=True)
class BulkConfig:
    """Parameters of the bulk load of a table export (``change_log`` as in ``StreamConfig``)."""

    export_path: str
    table_name: str
    key_names: tuple[str, ...]
    target: TargetConfig | None
    run_id: str
    load_time_millis: int | None = None
    lookup: LookupConfig | None = None
    decode: DecodeOptions = field(default_factory=DecodeOptions)
    change_log: str | None = None

    def __post_init__(self):
        keys = split_key_names(self.key_names) if isinstance(self.key_names, str) else tuple(self.key_names)
        object.__setattr__(self, "key_names", tuple(k.strip() for k in keys if k and k.strip()))
        _require(
            export_path=self.export_path,
            table_name=self.table_name,
            key_names=self.key_names,
            run_id=self.run_id,
        )
        _check_outputs(self.target, self.change_log, self.lookup)

    @property
    def data_path(self) -> str:
        return self.export_path.rstrip("/") + "/data/"
