"""Settings shared by the fit, the encoders and the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class MixtureConfig:
    """Settings of the one-dimensional Dirichlet-process mixture."""

    # Defaults that results depend on.
    n_components: int = 10
    weight_concentration_prior: float = 0.001
    max_iter: int = 100
    n_init: int = 1
    random_state: int = 42
    eps: float = 0.005
    clip_min: float = -0.99
    clip_max: float = 0.99
    normalization_factor: float = 4.0
    # Stopping and regularisation constants of the solver.
    tol: float = 1e-3
    reg_covar: float = 1e-6
    # Where the fit starts: "bins" of equal row count (further runs: seeded bins), or seeded "kmeans".
    start: str = "bins"

    def __post_init__(self) -> None:
        if self.n_components < 1:
            raise ValueError("n_components must be at least 1")
        if self.max_iter < 1 or self.n_init < 1:
            raise ValueError("max_iter and n_init must be at least 1")
        if self.weight_concentration_prior <= 0:
            raise ValueError("weight_concentration_prior must be positive")
        if self.start not in ("bins", "kmeans"):
            raise ValueError("start must be 'bins' or 'kmeans'")
        if not self.clip_min < self.clip_max:
            raise ValueError("clip_min must lie below clip_max")


# Fixed value: stands for "missing" among the modal values of a mixed column.
MISSING_MARKER = -9999999.0


@dataclass(frozen=True)
class TableSpec:
    """Which columns of a table are categorical or mixed; the rest is continuous.

    Columns are given by name or by position.  ``continuous`` picks how numbers
    are normalised: ``"mixture"`` (mode plus value within the mode) or
    ``"minmax"`` (rescaled to [-1, 1]).  ``categories`` is ``"ranked"`` (one-hot
    position is the frequency rank) or ``"codes"`` (the value is the position).
    A categorical column becomes a one-hot block of columns, one index column if it is listed in
    ``indexed``, or a one-hot block as a sparse vector if it is listed in ``sparse``; the data never
    decide that.  A block of more than ``one_hot_width`` columns is an error, unless ``wide`` is
    ``"sparse"``: then such a block, and only such a one, is a sparse vector.
    """

    categorical: Sequence[str | int] = ()
    mixed: Mapping[str | int, Sequence[float]] = field(default_factory=dict)
    columns: Sequence[str] | None = None
    continuous: str = "mixture"
    categories: str = "ranked"
    unseen: str = "zero"
    missing_marker: float = MISSING_MARKER
    indexed: Sequence[str | int] = ()
    sparse: Sequence[str | int] = ()
    one_hot_width: int = 2048
    wide: str = "error"

    def __post_init__(self) -> None:
        if self.continuous not in ("mixture", "minmax"):
            raise ValueError("continuous must be 'mixture' or 'minmax'")
        if self.categories not in ("ranked", "codes"):
            raise ValueError("categories must be 'ranked' or 'codes'")
        if self.unseen not in ("zero", "error"):
            raise ValueError("unseen must be 'zero' or 'error'")
        if self.wide not in ("error", "sparse"):
            raise ValueError("wide must be 'error' or 'sparse'")
