"""Mode-specific encoding of table columns on Spark."""

from modeforge.config import MISSING_MARKER, MixtureConfig, TableSpec
from modeforge.operators.codec import ModeEncoder, ModeNormalizer
from modeforge.operators.fit import fit_mixture, fit_mixtures
from modeforge.operators.generate import inflate
from modeforge.operators.metrics import MetricsLog
from modeforge.operators.table import TableEncoder
from modeforge.operators.validate import validate_columns
from modeforge.plans.jobs import encode_job, generation_job

__all__ = [
    "MISSING_MARKER",
    "MetricsLog",
    "MixtureConfig",
    "ModeEncoder",
    "ModeNormalizer",
    "TableEncoder",
    "TableSpec",
    "encode_job",
    "fit_mixture",
    "fit_mixtures",
    "generation_job",
    "inflate",
    "validate_columns",
]
