"""Encode a numeric column as (value within a mode, one-hot mode) and back.

Both directions are projections: rows never move, other columns pass through,
and the work is columns x components fused arithmetic per row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeforge.config import MixtureConfig
from modeforge.functions import mixture as mx
from modeforge.functions.text import first_largest, largest, number, quoted
from modeforge.functions.uniform import key_columns, keyed_uniform
from modeforge.operators.fit import fit_mixture
from modeforge.operators.model import Mixture, from_parameters, parameters
from modeforge.sources.files import read_parquet, write_parquet

NORMALIZED, ENCODING, MODE, OVERFLOW = "normalized_value", "mode_encoding", "mode", "overflow"


@dataclass(frozen=True)
class ModeRequest:
    """A value (SQL text) to be given a mode, and the prefix of what is added.

    ``tag`` keeps the draws of several columns apart.
    """

    x: str
    tag: str
    mixture: Mixture
    prefix: str


def with_modes(
    df: DataFrame,
    requests: Sequence[ModeRequest],
    key: Sequence[str],
    cfg: MixtureConfig,
    portable: bool,
) -> DataFrame:
    """Add, per request, ``{p}ok`` whether there is a value, ``{p}x`` the value,
    ``{p}z`` its drawn position in ``mixture.kept``, ``{p}n`` the scaled value."""
    parts = _parts(requests)
    for part in parts:
        stages, names, scaled = [], [], []
        for r in part:
            m, p = r.mixture, r.prefix
            u = keyed_uniform(key, cfg.random_state, f"mode:{r.tag}", portable)
            stages.append(
                [
                    *mx.responsibility_stages(r.x, m.consts, m.half_precisions, m.means, p),
                    *mx.draw_stages(m.kept, u, p),
                ]
            )
            names += [f"{p}ok", f"{p}x", f"{p}z"]
            n = mx.scaled_within(
                f"{p}x", f"{p}z", m.kept_means, m.kept_spreads, cfg.normalization_factor
            )
            scaled.append(f"{n} AS {p}n")
        kept = [quoted(c) for c in df.columns]
        df = mx.fenced(mx.apply_stages(df, stages), kept, names).selectExpr("*", *scaled)
        if len(parts) > 1:
            df = mx.apart(df)
    return df


def _parts(requests: Sequence[ModeRequest]) -> list[list[ModeRequest]]:
    """Requests that share their projections: as many as compile into one method."""
    parts: list[list[ModeRequest]] = []
    size = 0
    for r in requests:
        size += r.mixture.size
        if not parts or size > mx.FUSED_COMPONENTS:
            parts.append([])
            size = r.mixture.size
        parts[-1].append(r)
    return parts


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def restored(value: str, kind: str) -> str:
    """A decoded value in the type of its overflow column; null where it does not fit."""
    if kind in _WHOLE:
        return f"try_cast(round({value}) AS {kind})"
    return value if kind == "double" else f"try_cast({value} AS {kind})"


def survives(x: str, value: str, kind: str) -> str:
    """Whether decoding to ``value`` gives back ``x`` to the last bit, the sign of a zero included."""
    back = restored(value, kind)
    same = f"{back} = {x}"
    if kind in ("double", "float"):
        same += f" AND ({x} <> 0 OR CAST({back} AS STRING) = CAST({x} AS STRING))"
    return f"coalesce({same}, false)"


def overflow(x: str, value: str, kind: str) -> str:
    """The raw value where decoding, ``value``, would give another one."""
    return f"CASE WHEN {survives(x, value, kind)} THEN NULL ELSE {x} END"


def decoded(p: str, m: Mixture, cfg: MixtureConfig) -> str:
    """What decoding makes of a value that ``with_modes`` has placed."""
    n = normalized(p, cfg)
    if cfg.clip_min < -1.0 or cfg.clip_max > 1.0:
        n = mx.clipped(f"({n})", -1.0, 1.0)
    return mx.unscaled(f"({n})", f"{p}z", m.kept_means, m.kept_spreads, cfg.normalization_factor)


def normalized(p: str, cfg: MixtureConfig) -> str:
    """The scaled value within the clip range; null where there is no value."""
    return f"CASE WHEN {p}ok THEN {mx.clipped(f'{p}n', cfg.clip_min, cfg.clip_max)} END"


@dataclass(frozen=True)
class ModeEncoder:
    """Mode-specific normalisation of one column with a fitted mixture."""

    column: str
    mixture: Mixture
    config: MixtureConfig = MixtureConfig()

    def encode(
        self,
        df: DataFrame,
        key: str | Sequence[str] | None = None,
        *,
        lossless: bool = False,
        drop_input: bool = False,
        with_mode: bool = False,
        ranked: bool = False,
        portable: bool = False,
        prefix: str = "",
    ) -> DataFrame:
        """Add ``normalized_value: double`` and ``mode_encoding: array<double>``.

        ``key`` identifies rows and makes the mode draw repeatable (see
        ``functions.uniform``).  Null, NaN and infinite values get a null
        normalised value and an all-zero mode.  ``lossless`` adds ``overflow``
        with the raw value of every row that would be decoded to anything else,
        by clipping, by rounding or for its type; ``ranked``
        orders the one-hot positions by descending frequency; ``with_mode``
        adds the position itself; ``drop_input`` keeps only the new columns.
        ``prefix`` goes before the new names, so that several columns of a table
        can be encoded; a name that the table has already is an error.
        """
        m, cfg, p = self.mixture, self.config, "__e_"
        added = [NORMALIZED, ENCODING, *[MODE] * with_mode, *[OVERFLOW] * lossless]
        taken = sorted({prefix + name for name in added} & set(df.columns))
        if taken and not drop_input:
            raise ValueError(f"the table has columns {', '.join(taken)}; choose a prefix")
        kind = df.schema[self.column].dataType.simpleString()
        positions = m.order if ranked else range(len(m.kept))
        x = quoted(self.column)
        request = ModeRequest(x, self.column, m, p)
        staged = with_modes(df, [request], key_columns(key), cfg, portable)
        places = {i: place for place, i in enumerate(positions)}
        hot = [
            "array(" + ", ".join("1.0D" if i == j else "0.0D" for j in positions) + ")"
            for i in range(len(places) + 1)
        ]
        out = [
            f"{normalized(p, cfg)} AS {quoted(prefix + NORMALIZED)}",
            f"{mx.lookup(f'{p}z', hot)} AS {quoted(prefix + ENCODING)}",
        ]
        if with_mode:
            order = [*(str(places[i]) for i in range(len(places))), "CAST(NULL AS INT)"]
            out.append(f"{mx.lookup(f'{p}z', order)} AS {quoted(prefix + MODE)}")
        if lossless:
            out.append(f"{overflow(x, decoded(p, m, cfg), kind)} AS {quoted(prefix + OVERFLOW)}")
        kept = [] if drop_input else [quoted(c) for c in df.columns]
        return staged.selectExpr(*kept, *out)

    def decode(
        self,
        df: DataFrame,
        output: str | None = None,
        *,
        ranked: bool = False,
        clip: bool = True,
        keep_input: bool = False,
        prefix: str = "",
    ) -> DataFrame:
        """Values from ``normalized_value`` and ``mode_encoding``.

        The mode is the position of the first largest entry.  ``clip`` limits
        the normalised value to [-1, 1] first.  Where an ``overflow`` column
        exists and holds a value, that value is returned as it is, and the
        others come in its type.
        """
        m = self.mixture
        norm, encoding, spill = (quoted(prefix + c) for c in (NORMALIZED, ENCODING, OVERFLOW))
        positions = list(m.order if ranked else range(len(m.kept)))
        n = mx.clipped(norm, -1.0, 1.0) if clip else norm
        value = mx.unscaled(
            "__d_n",
            "__d_z",
            [m.kept_means[i] for i in positions],
            [m.kept_spreads[i] for i in positions],
            self.config.normalization_factor,
        )
        if prefix + OVERFLOW in df.columns:
            kind = df.schema[prefix + OVERFLOW].dataType.simpleString()
            value = f"coalesce({spill}, {restored(value, kind)})"
        name = output or self.column
        kept = [quoted(c) for c in df.columns if c != name] if keep_input else []
        return df.selectExpr(
            "*",
            f"CAST(array_position({encoding}, array_max({encoding})) - 1 AS INT) AS __d_z",
            f"{n} AS __d_n",
        ).selectExpr(*kept, f"{value} AS {quoted(name)}")

    def with_config(self, **changes: object) -> ModeEncoder:
        return replace(self, config=replace(self.config, **changes))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the parameters and the configuration as a small parquet table."""
        rows = parameters(spark, {self.column: self.mixture})
        rows = rows.withColumn("config", F.lit(json.dumps(asdict(self.config))))
        write_parquet(rows.coalesce(1), path)

    @classmethod
    def load(
        cls, spark: SparkSession, path: str, config: MixtureConfig | None = None
    ) -> ModeEncoder:
        """The encoder as it was saved; ``config`` replaces the saved one."""
        rows = read_parquet(spark, path)
        ((column, m),) = from_parameters(rows).items()
        if config is None:
            config = MixtureConfig(**json.loads(rows.first()["config"]))
        return cls(column, m, config)


def flat_decode(
    block: Sequence[str],
    norm: str,
    m: Mixture | None,
    cfg: MixtureConfig,
    p: str,
    points: Sequence[float] = (),
) -> tuple[list[mx.Stage], str]:
    """Stages and value of a flat block: ``points`` first, then ``m.kept``, in
    the order of ``block``'s column expressions."""
    stages = [
        [(f"{p}b", largest(list(block))), (f"{p}n", mx.clipped(norm, -1.0, 1.0))],
        [(f"{p}z", first_largest(block, f"{p}b"))],
    ]
    means, spreads = (m.kept_means, m.kept_spreads) if m else ((), ())
    centres = [number(v) for v in (*points, *means)]
    widths = ["0.0D"] * len(points)
    widths += [number(cfg.normalization_factor * s) for s in spreads]
    width, centre = (mx.lookup_or_null(f"{p}z", values) for values in (widths, centres))
    value = f"({p}n * {width} + {centre})"
    return stages, value


class ModeNormalizer:
    """Fit, transform and inverse-transform of one column, with state checks."""

    def __init__(self, column: str = "Amount", config: MixtureConfig | None = None) -> None:
        self.column = column
        self.config = config or MixtureConfig()
        self._encoder: ModeEncoder | None = None

    def fit(self, df: DataFrame) -> ModeNormalizer:
        mixture = fit_mixture(df.select(quoted(self.column)), self.column, self.config)
        self._encoder = ModeEncoder(self.column, mixture, self.config)
        return self

    @property
    def encoder(self) -> ModeEncoder:
        if self._encoder is None:
            raise ValueError("fit the model before encoding or decoding")
        return self._encoder

    def transform(
        self, df: DataFrame, key: str | Sequence[str] | None = None, **options
    ) -> DataFrame:
        return self.encoder.encode(df, key, **options)

    def inverse_transform(self, df: DataFrame, **options) -> DataFrame:
        return self.encoder.decode(df, **options)
