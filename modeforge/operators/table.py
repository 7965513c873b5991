"""Encode whole tables of mixed column kinds into flat numeric tables and back.

A column becomes a block of double columns: a continuous one a normalised value
and a one-hot mode, a mixed one the same with its modal values as extra
positions, a categorical one a one-hot category, an index, or a sparse vector.  Fitting reads the table a
fixed number of times whatever its width: one pass for measures, one for
categories, one to compress the numeric columns.  Encoding and decoding are
projections.  Categories are tables too, looked up by joins: only those of narrow blocks,
``LITERALS`` at the most, are ever taken to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from modeforge.config import MixtureConfig, TableSpec
from modeforge.functions import mixture as mx
from modeforge.functions.scaling import from_min_max, to_min_max
from modeforge.functions.text import first_largest, largest, number, quoted, string
from modeforge.functions.uniform import key_columns
from modeforge.operators.codec import ModeRequest, decoded, flat_decode, normalized, overflow, restored, with_modes
from modeforge.operators.compress import NumericProfile, profile_numeric
from modeforge.operators.fit import fit_profiled
from modeforge.operators.model import Mixture, from_parameters, parameters
from modeforge.operators.lookup import Dictionary, Lookup, look_up
from modeforge.operators.profile import ranked_categories
from modeforge.sources.files import read_parquet, write_parquet
from modeforge.sources.scratch import kept_table

CONTINUOUS, MIXED, CATEGORICAL = "continuous", "mixed", "categorical"
TANH, SOFTMAX, INDEX = "tanh", "softmax", "index"

LAYOUT_SCHEMA = "column string, start int, width int, activation string"
METADATA_SCHEMA = (
    "column string, kind string, min double, max double, size int, "
    "modal_values array<double>, categories array<string>"
)


@dataclass(frozen=True)
class ColumnCode:
    """What is needed to encode and decode one column.

    ``points`` are the modal values of a mixed column with their normalised
    values; ``order`` lists the one-hot positions (points first, then modes) by
    descending frequency.  ``values`` are categories in their string form.
    ``indexed`` columns have one index column and ``sparse`` ones a vector; a ``dictionary``
    holds their categories, and those of wide blocks, unless codes are their own place.
    """

    name: str
    kind: str
    type: str
    low: float | None = None
    high: float | None = None
    mixture: Mixture | None = None
    points: tuple[float, ...] = ()
    point_norms: tuple[float, ...] = ()
    order: tuple[int, ...] = ()
    values: tuple[str, ...] = ()
    size: int = 0
    indexed: bool = False
    dictionary: Dictionary | None = None
    sparse: bool = False

    @property
    def blocks(self) -> list[tuple[int, str]]:
        if self.kind == CATEGORICAL:
            return [(1, INDEX)] if self.indexed else [(self.size, SOFTMAX)]
        if self.order:
            return [(1, TANH), (len(self.order), SOFTMAX)]
        return [(1, TANH)]

    @property
    def width(self) -> int:
        """Flat columns; a sparse vector is none of them."""
        return 0 if self.sparse else sum(w for w, _ in self.blocks)


def modal_norms(
    points: Sequence[float], whole: Mixture, cfg: MixtureConfig, marker: float
) -> tuple[float, ...]:
    """Each modal value within the closest component of the mixture over all
    values; the marker for missing values is 0."""

    def norm(v: float) -> float:
        if v == marker:
            return 0.0
        k = min(range(whole.size), key=lambda i: abs(v - whole.means[i]))
        scaled = (v - whole.means[k]) / (cfg.normalization_factor * whole.variances[k] ** 0.5)
        return max(cfg.clip_min, min(cfg.clip_max, scaled))

    return tuple(norm(v) for v in points)


class TableEncoder:
    """Fit, transform and inverse-transform of a table."""

    def __init__(self, spec: TableSpec | None = None, config: MixtureConfig | None = None) -> None:
        self.spec = spec or TableSpec()
        self.config = config or MixtureConfig()
        self._codes: list[ColumnCode] | None = None

    @classmethod
    def from_codes(
        cls,
        codes: Sequence[ColumnCode],
        spec: TableSpec | None = None,
        config: MixtureConfig | None = None,
    ) -> TableEncoder:
        """Encoder with given codes instead of fitted ones."""
        encoder = cls(spec, config)
        encoder._codes = list(codes)
        return encoder

    @property
    def codes(self) -> list[ColumnCode]:
        if self._codes is None:
            raise ValueError("fit the encoder before encoding or decoding")
        return self._codes

    # ---------------------------------------------------------------- fit

    def fit(self, df: DataFrame) -> TableEncoder:
        spec, cfg = self.spec, self.config
        columns = list(spec.columns or df.columns)
        df = df.select(*map(quoted, columns))
        categorical = [_named(c, columns) for c in spec.categorical]
        mixed = {
            _named(c, columns): tuple(float(v) for v in vs) for c, vs in spec.mixed.items()
        }
        if set(categorical) & set(mixed):
            raise ValueError("a column cannot be both categorical and mixed")
        indexed = [_named(c, columns) for c in spec.indexed]
        sparse = [_named(c, columns) for c in spec.sparse]
        if not set(indexed) | set(sparse) <= set(categorical):
            raise ValueError("only categorical columns can be indexed or sparse")
        if set(indexed) & set(sparse):
            raise ValueError("a column cannot be both indexed and sparse")
        types = {f.name: f.dataType for f in df.schema.fields}
        numeric = [c for c in columns if c not in categorical]
        for c in numeric:
            if not isinstance(types[c], NumericType):
                raise ValueError(f"column {c} is not numeric; list it as categorical")

        # One pass: measures of all numbers, sizes of all categories and points.
        exprs = {}
        for c in numeric:
            exprs[c] = quoted(c)
            if c in mixed and spec.continuous == "mixture":
                exprs[_rest(c)] = _apart_from(quoted(c), mixed[c])
        sizes = {}
        for c in categorical:
            sizes[f"{c}:null"] = f"count_if({quoted(c)} IS NULL)"
            if spec.categories == "codes":
                sizes[f"{c}:min"] = f"min(CAST({quoted(c)} AS BIGINT))"
                sizes[f"{c}:max"] = f"max(CAST({quoted(c)} AS BIGINT))"
        for c, points in mixed.items():
            for i, v in enumerate(points):
                sizes[f"{c}:{i}"] = f"count_if({quoted(c)} = {number(v)})"
        profiles, counted = profile_numeric(df, exprs, sizes)

        # One pass: categories of all columns that get a one-hot block of columns.
        narrow = [c for c in categorical if c not in [*indexed, *sparse] and spec.categories == "ranked"]
        values, tables = self._blocks(df, narrow)

        mixtures = {}
        if spec.continuous == "mixture":
            wanted = {c: e for c, e in exprs.items() if profiles[c].rows > 0}
            for c in numeric:
                if profiles[c].rows == 0:
                    raise ValueError(f"no finite value to fit in {c}")
            mixtures = fit_profiled(df, wanted, profiles, cfg) if wanted else {}

        codes = []
        for c in columns:
            ddl = types[c].simpleString()
            if c in categorical:
                codes.append(self._category(df, c, ddl, values.get(c), tables.get(c), counted, c in indexed, c in sparse))
            elif c in mixed:
                hits = [counted[f"{c}:{i}"] for i in range(len(mixed[c]))]
                codes.append(self._mixed(c, ddl, profiles[c], mixtures, mixed[c], hits))
            else:
                codes.append(self._continuous(c, ddl, profiles[c], mixtures.get(c)))
        self._codes = codes
        return self

    def _blocks(
        self, df: DataFrame, narrow: list[str]
    ) -> tuple[dict[str, list[str]], dict[str, Dictionary]]:
        """Categories of one-hot columns: lists of the few, tables of the others."""
        if not narrow:
            return {}, {}
        ranked = kept_table(ranked_categories(df, narrow), "categories")
        measured = ranked.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("size"))
        found = {r["column"]: (r["n"], r["size"]) for r in measured.collect()}
        wide = [c for c, (n, _) in found.items() if self._too_wide(c, n)]
        few = [
            c for c in narrow
            if c not in wide and found.get(c, (0, 0))[0] <= LITERALS and found.get(c, (0, 0))[1] <= LITERAL_BYTES
        ]
        values: dict[str, list[str]] = {c: [] for c in few}
        if few:
            for row in ranked.where(F.col("column").isin(few)).orderBy("column", "idx").collect():
                values[row["column"]].append(row["value"])
        tables = {
            c: Dictionary(ranked.where(F.col("column") == c).select("value", "idx"), *found[c])
            for c in narrow
            if c not in values
        }
        return values, tables

    def _too_wide(self, c: str, width: int) -> bool:
        """Whether a block of columns is to be a sparse vector instead; an error, if that was not asked for."""
        if width > self.spec.one_hot_width and self.spec.wide == "error":
            raise ValueError(
                f"column {c} has {width} categories, more than the {self.spec.one_hot_width} columns a one-hot block "
                "may have; list it in indexed or sparse, or raise one_hot_width"
            )
        return width > self.spec.one_hot_width

    def _category(
        self,
        df: DataFrame,
        c: str,
        ddl: str,
        values: list[str] | None,
        table: Dictionary | None,
        counted: dict[str, object],
        indexed: bool,
        sparse: bool,
    ) -> ColumnCode:
        if self.spec.categories == "codes":
            if (counted[f"{c}:min"] or 0) < 0:
                raise ValueError(f"column {c} has negative codes")
            top = counted[f"{c}:max"]
            # A null counts as a category of its own when positions are codes.
            size = (0 if top is None else top + 1) + (1 if counted[f"{c}:null"] else 0)
            sparse = sparse or not indexed and self._too_wide(c, size)
            return ColumnCode(c, CATEGORICAL, ddl, size=size, indexed=indexed, sparse=sparse)
        if indexed or sparse:
            # Kept as a table, which a stream can be joined with too.
            ranked = kept_table(ranked_categories(df, [c]).select("value", "idx"), "categories")
            measured = ranked.agg(F.count("*"), F.sum(F.octet_length("value"))).first()
            table = Dictionary(ranked, measured[0], measured[1] or 0)
        elif table is not None:
            sparse = self._too_wide(c, table.size)
        if table is not None:
            return ColumnCode(
                c, CATEGORICAL, ddl, size=table.size, indexed=indexed, dictionary=table, sparse=sparse
            )
        return ColumnCode(c, CATEGORICAL, ddl, values=tuple(values), size=len(values))

    def _continuous(
        self, c: str, ddl: str, p: NumericProfile, m: Mixture | None
    ) -> ColumnCode:
        return ColumnCode(c, CONTINUOUS, ddl, p.low, p.high, m, order=m.order if m else ())

    def _mixed(
        self,
        c: str,
        ddl: str,
        p: NumericProfile,
        mixtures: dict[str, Mixture],
        points: tuple[float, ...],
        hits: list[int],
    ) -> ColumnCode:
        if self.spec.continuous == "minmax":
            return ColumnCode(
                c, MIXED, ddl, p.low, p.high, points=points, order=tuple(range(len(points)))
            )
        rest = mixtures.get(_rest(c))
        counts = [*hits, *(rest.frequency[k] for k in (rest.kept if rest else ()))]
        return ColumnCode(
            c, MIXED, ddl, p.low, p.high, rest, points,
            modal_norms(points, mixtures[c], self.config, self.spec.missing_marker),
            tuple(sorted(range(len(counts)), key=lambda i: (-counts[i], i))),
        )

    # ------------------------------------------------------ save and load

    def save(self, spark: SparkSession, path: str) -> None:
        """Write settings and codes, mixtures and dictionaries as parquet tables below ``path``."""
        settings = json.dumps(
            {"spec": asdict(self.spec) | {"mixed": list(self.spec.mixed.items())}, "config": asdict(self.config)}
        )
        rows = []
        for i, code in enumerate(self.codes):
            plain = {k: v for k, v in vars(code).items() if k not in ("mixture", "dictionary")}
            size = code.dictionary.text_bytes if code.dictionary else None
            rows.append((i, json.dumps(plain), size, settings))
        codes = spark.createDataFrame(rows, "place int, code string, text_bytes bigint, settings string")
        write_parquet(codes.coalesce(1), f"{path}/codes")
        mixtures = {str(i): c.mixture for i, c in enumerate(self.codes) if c.mixture is not None}
        if mixtures:
            write_parquet(parameters(spark, mixtures).coalesce(1), f"{path}/mixtures")
        for i, code in enumerate(self.codes):
            if code.dictionary is not None:
                write_parquet(code.dictionary.entries, f"{path}/dictionary-{i}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TableEncoder:
        """The encoder as it was saved."""
        rows = sorted(read_parquet(spark, f"{path}/codes").collect())
        settings = json.loads(rows[0]["settings"])
        parts = [json.loads(r["code"]) for r in rows]
        mixtures = {}
        if any(p["order"] and p["kind"] == CONTINUOUS or p["point_norms"] for p in parts):
            mixtures = from_parameters(read_parquet(spark, f"{path}/mixtures"))
        codes = []
        for i, (row, plain) in enumerate(zip(rows, parts)):
            tuples = {k: tuple(v) if isinstance(v, list) else v for k, v in plain.items()}
            dictionary = None
            if row["text_bytes"] is not None:
                entries = read_parquet(spark, f"{path}/dictionary-{i}")
                dictionary = Dictionary(entries, plain["size"], row["text_bytes"])
            codes.append(ColumnCode(**tuples, mixture=mixtures.get(str(i)), dictionary=dictionary))
        # What was left empty is the default again, an empty tuple.
        given = {k: v for k, v in settings["spec"].items() if v != []}
        spec = given | {"mixed": dict(map(tuple, settings["spec"]["mixed"]))}
        return cls.from_codes(codes, TableSpec(**spec), MixtureConfig(**settings["config"]))

    # ------------------------------------------------------------- layout

    @property
    def output_info(self) -> list[tuple[int, str]]:
        """Width and activation of every block."""
        return [block for code in self.codes for block in code.blocks]

    @property
    def output_dimensions(self) -> int:
        """The number of flat columns."""
        return sum(code.width for code in self.codes)

    def layout(self, spark: SparkSession) -> DataFrame:
        """``start`` is the first flat column of a block; null for a sparse vector."""
        rows, start = [], 0
        for code in self.codes:
            for width, activation in code.blocks:
                rows.append((code.name, None if code.sparse else start, width, activation))
                start += 0 if code.sparse else width
        return spark.createDataFrame(rows, LAYOUT_SCHEMA)

    def _categories(self, code: ColumnCode) -> list[str] | None:
        """The categories of a block of columns, as many as it is wide at the most."""
        if code.kind != CATEGORICAL:
            return None
        if code.indexed or code.sparse:
            return []
        if self.spec.categories == "codes":
            return [str(i) for i in range(code.size)]
        if code.dictionary is not None:
            return [r["value"] for r in code.dictionary.entries.orderBy("idx").collect()]
        return list(code.values)

    def metadata(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                c.name, c.kind, c.low, c.high,
                c.size if c.kind == CATEGORICAL else None,
                list(c.points) if c.kind == MIXED else None,
                self._categories(c),
            )
            for c in self.codes
        ]
        return spark.createDataFrame(rows, METADATA_SCHEMA)

    # ---------------------------------------------------------- transform

    def transform(
        self,
        df: DataFrame,
        key: str | Sequence[str] | None = None,
        *,
        keep: Sequence[str] = (),
        lossless: bool = False,
        portable: bool = False,
    ) -> DataFrame:
        """Columns ``keep``, then ``col_0 ... col_{D-1}``, then ``sparse_<column>`` of sparse columns.

        A sparse vector is ``struct<size, indices, values>``.
        ``lossless`` adds ``overflow_<column>`` with the raw value of the rows
        that would be decoded to anything else.
        """
        cfg, keys = self.config, key_columns(key)
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        df = self._with_places(df)
        requests, out, extra, vectors = [], [], [], []
        for i, code in enumerate(self.codes):
            p, x = f"__{i}_", quoted(code.name)
            if code.kind == CATEGORICAL:
                if code.indexed:
                    out.append(f"CAST({p}idx AS DOUBLE)")
                elif code.sparse:
                    vectors.append(f"{_vector(f'{p}idx', code.size)} AS {quoted('sparse_' + code.name)}")
                else:
                    out += [mx.indicator(f"{p}idx = {k}") for k in range(code.size)]
                continue
            if code.mixture is not None:
                requests.append(ModeRequest(_apart_from(x, code.points), code.name, code.mixture, p))
                norm, modes = normalized(p, cfg), len(code.mixture.kept)
                back = decoded(p, code.mixture, cfg)
            elif code.point_norms:
                norm, modes = "CAST(NULL AS DOUBLE)", 0
                back = norm
            else:
                norm, modes = to_min_max(mx.finite(x), code.low, code.high), 0
                back = from_min_max(f"({norm})", code.low, code.high)
            if lossless:
                if code.points:
                    back = f"CASE {_whens(x, code.points, code.points)} ELSE {back} END"
                spill = overflow(x, f"({back})", types[code.name])
                extra.append(f"{spill} AS {quoted('overflow_' + code.name)}")
            if code.points:
                norms = code.point_norms or [0.0] * len(code.points)
                norm = f"CASE {_whens(x, code.points, norms)} ELSE {norm} END"
            hot = [mx.indicator(f"{x} = {number(v)}") for v in code.points]
            hot += [mx.indicator(f"{p}z = {k}") for k in range(modes)]
            out += [norm, *(hot[j] for j in code.order)]
        named = [f"{text} AS col_{i}" for i, text in enumerate(out)]
        staged = with_modes(df, requests, keys, cfg, portable)
        return staged.selectExpr(*map(quoted, keep), *named, *vectors, *extra)

    def _with_places(self, df: DataFrame) -> DataFrame:
        """Add ``__{i}_idx``, the place of every category, found once per row."""
        codes = [(i, c) for i, c in enumerate(self.codes) if c.kind == CATEGORICAL]
        if not codes:
            return df
        lookups = [
            Lookup(
                c.dictionary, f"CAST({quoted(c.name)} AS STRING)", "value", "CAST(idx AS BIGINT)", f"__{i}_idx"
            )
            for i, c in codes
            if c.dictionary is not None
        ]
        df = look_up(df, lookups)
        places, width = [], 0
        for i, c in codes:
            x, text = quoted(c.name), f"CAST({quoted(c.name)} AS STRING)"
            if c.dictionary is not None:
                place = f"__{i}_idx"
            elif self.spec.categories == "codes":
                code = f"CAST({x} AS BIGINT)"
                place = f"CASE WHEN {code} >= 0 AND {code} < {c.size} THEN {code} END"
            elif c.values:
                place = f"nullif(array_position(array({', '.join(map(string, c.values))}), {text}), 0) - 1"
            else:
                place = "CAST(NULL AS BIGINT)"
            if self.spec.unseen == "error":
                message = string(f"unseen category in {c.name}: ")
                place = (
                    f"CASE WHEN {x} IS NOT NULL AND ({place}) IS NULL "
                    f"THEN CAST(raise_error(concat({message}, {text})) AS BIGINT) ELSE {place} END"
                )
            places.append(f"{place} AS __{i}_idx")
            width += 0 if c.indexed or c.sparse else c.size
        found = {f"__{i}_idx" for i, _ in codes}
        df = df.selectExpr(*(quoted(c) for c in df.columns if c not in found), *places)
        # Wide blocks are compiled apart from the search.
        return mx.apart(df) if width > _WIDE else df

    # ------------------------------------------------------------ inverse

    def inverse_transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Columns ``keep``, then the decoded columns under their own names.

        The largest entry of a one-hot block decides, the first one on a tie;
        normalised values are limited to [-1, 1].  Categories come back in
        their own type, numbers as doubles, or in the type of their overflow
        column where there is one.
        """
        stages, out, start = [], [], 0
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        lookups, places = [], []
        for i, code in enumerate(self.codes):
            block = [f"col_{start + j}" for j in range(code.width)]
            start += code.width
            if code.kind == CATEGORICAL and not code.values and code.size:
                if code.indexed:
                    place = f"CAST({block[0]} AS BIGINT)"
                elif code.sparse:
                    place = _of_vector(quoted(f"sparse_{code.name}"))
                else:
                    place = _of_block(block)
                places.append(f"{place} AS __{i}_place")
                if code.dictionary is not None:
                    lookups.append(Lookup(code.dictionary, f"__{i}_place", "idx", "value", f"__{i}_value"))
        if places:
            df = df.selectExpr("*", *places)
        df = look_up(df, lookups)
        start = 0
        for i, code in enumerate(self.codes):
            p = f"__{i}_"
            block = [f"col_{start + j}" for j in range(code.width)]
            start += code.width
            if code.dictionary is not None:
                value = f"CAST({p}value AS {code.type})"
            elif code.kind == CATEGORICAL and not code.values:
                # Codes are their own place.
                value = f"CAST({f'{p}place' if code.size else 'NULL'} AS {code.type})"
            elif code.kind == CATEGORICAL:
                place = first_largest(block, f"{p}b")
                stages.append(
                    [
                        [(f"{p}b", largest(block))],
                        [(f"{p}z", f"CASE WHEN {p}b = 0 THEN NULL ELSE {place} END")],
                    ]
                )
                value = mx.lookup_or_null(f"{p}z", _literals(code))
            else:
                norm, hot = block[0], _natural(block[1:], code.order)
                if code.mixture is not None or code.point_norms:
                    levels, value = flat_decode(
                        hot, norm, code.mixture, self.config, p, code.points
                    )
                    stages.append(levels)
                else:
                    value = from_min_max(mx.clipped(norm, -1.0, 1.0), code.low, code.high)
                    if code.points:
                        whens = " ".join(
                            f"WHEN {h} > 0 AND {h} = {largest(hot)} THEN {number(v)}"
                            for h, v in zip(hot, code.points)
                        )
                        value = f"CASE {whens} ELSE {value} END"
                spill = f"overflow_{code.name}"
                if spill in types:
                    value = f"coalesce({quoted(spill)}, {restored(value, types[spill])})"
            out.append(f"{value} AS {quoted(code.name)}")
        for first in range(0, len(stages), _DECODED_AT_ONCE):
            df = mx.apply_stages(df, stages[first : first + _DECODED_AT_ONCE])
            if len(stages) > _DECODED_AT_ONCE:
                df = mx.apart(df)
        return df.selectExpr(*map(quoted, keep), *out)


# Categories of a block whose places are found by comparing, and the bytes of all of them.
LITERALS, LITERAL_BYTES = 64, 16_384


def _vector(place: str, size: int) -> str:
    """One-hot vector as size, indices and values; without a place it has no entry."""
    return (
        f"named_struct('size', {size}L, 'indices', CASE WHEN {place} IS NULL THEN CAST(array() AS array<bigint>) "
        f"ELSE array(CAST({place} AS BIGINT)) END, 'values', CASE WHEN {place} IS NULL THEN CAST(array() AS array<double>) "
        "ELSE array(1.0D) END)"
    )


def _of_vector(vector: str) -> str:
    """The first place of the largest value of a vector; null if none is above 0."""
    best = f"array_max({vector}.values)"
    return f"CASE WHEN {best} > 0 THEN {vector}.indices[array_position({vector}.values, {best}) - 1] END"


def _of_block(block: Sequence[str]) -> str:
    """The same of a block of columns."""
    columns = f"array({', '.join(block)})"
    return f"CASE WHEN array_max({columns}) > 0 THEN array_position({columns}, array_max({columns})) - 1 END"


# Columns whose decoding still fits into one compiled method, and one-hot columns
# that do together with what comes before them.
_DECODED_AT_ONCE, _WIDE = 4, 64


def _rest(column: str) -> str:
    return f"{column} apart from its modal values"


def _apart_from(x: str, points: Sequence[float]) -> str:
    """The value, null where it is one of the points."""
    if not points:
        return x
    return f"CASE WHEN {x} IN ({', '.join(map(number, points))}) THEN NULL ELSE {x} END"


def _whens(x: str, points: Sequence[float], results: Sequence[float]) -> str:
    return " ".join(f"WHEN {x} = {number(v)} THEN {number(r)}" for v, r in zip(points, results))


def _named(column: str | int, columns: Sequence[str]) -> str:
    name = columns[column] if isinstance(column, int) else column
    if name not in columns:
        raise ValueError(f"no such column: {name}")
    return name


def _literals(code: ColumnCode) -> list[str]:
    return [f"CAST({string(v)} AS {code.type})" for v in code.values]


def _natural(block: Sequence[str], order: Sequence[int]) -> list[str]:
    """Block columns in the order of the positions they stand for."""
    places = {position: column for position, column in zip(order, block)}
    return [places[i] for i in range(len(block))]
