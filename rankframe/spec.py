"""What the data looks like and how a run is parameterised.

Every operator takes these objects instead of module constants, so the same code runs on
the production column names and on any other table with the same roles.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from datetime import date, timedelta

from rankframe.feature_names import CATEGORICAL_FEATURES, EMBEDDING_DIM, NUMERIC_FEATURES

# Both sides of training and serving rely on them, as on the defaults of the
# classes below.
MISSING_CATEGORY = "__MISSING__"
BUYER_HASH_MODULUS = 9_000_000_000_000
DAY_KEY_SCALE = 100_000
SAMPLE_RESOLUTION = 1_000_000

SURFACES = ("all", "boosted_merchants")


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of an interaction table."""

    numeric: tuple[str, ...] = NUMERIC_FEATURES
    categorical: tuple[str, ...] = CATEGORICAL_FEATURES
    buyer: str = "unified_buyer_id"
    product: str = "product_id"
    shop: str = "shop_id"
    day: str = "event_timestamp_day"
    label: str = "is_native_order"
    target: str = "target_is_native_order"
    buyer_hash: str = "ubi_hash"
    embedding_dim: int = EMBEDDING_DIM

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.buyer, self.product, self.shop, self.day)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def split_columns(self) -> tuple[str, ...]:
        """Columns of a training split before label and buyer hash; first mention wins."""
        return tuple(dict.fromkeys(self.keys + self.features))


@dataclass(frozen=True)
class SampleConfig:
    """Which rows go into a split.

    ``thin_share``: if given, an export reads the source once, and its first pass writes at most
    this share of the negatives; take a few times the share that should stay.
    """

    surface: str = "all"
    negative_scale: int = 20
    user_sample_pct: int = 100
    stop_date: str = "2026-03-08"
    base_start: str = ""
    base_stop: str = ""
    base_window_days: int = 30
    finetune_window_days: int = 1
    hash_algo: str = "xxhash64"
    thin_share: float | None = None

    def __post_init__(self) -> None:
        if self.thin_share is not None and not 0.0 < self.thin_share <= 1.0:
            raise ValueError("thin_share must be above 0 and at most 1")
        if self.surface not in SURFACES:
            raise ValueError(f"surface must be one of {SURFACES}, got {self.surface!r}")
        if self.negative_scale < 0:
            raise ValueError("negative_scale must not be negative")
        date.fromisoformat(self.stop_date)


@dataclass(frozen=True)
class PreprocessConfig:
    """Encoding parameters, and the layers of the model, saved next to the fitted state."""

    n_bins: int = 64
    id_hash: Mapping[str, tuple[int, int]] = field(default_factory=lambda: {"shop_id": (50_000, 16)})
    dim_overrides: Mapping[str, int] = field(default_factory=dict)
    hash_algo: str = "xxhash64"
    # layers of the model that is applied to the encoded rows; nothing here changes the encoding
    pretrained_emb_dim: int = EMBEDDING_DIM
    use_pretrained_embeddings: bool = True
    num_cross_layers: int = 3
    deep_dims: tuple[int, ...] = (512, 256, 128)
    head_dims: tuple[int, ...] = (64, 32)

    def __post_init__(self) -> None:
        if self.n_bins < 2:
            raise ValueError("n_bins must be at least 2")

    def model_shape(self, categories: Iterable[str]) -> ModelShape:
        return ModelShape(
            categories=tuple(sorted(categories)),
            n_bins=self.n_bins,
            cross_layers=self.num_cross_layers,
            deep_layers=len(self.deep_dims),
            head_layers=len(self.head_dims),
            embedding_dim=self.pretrained_emb_dim if self.use_pretrained_embeddings else 0,
        )


@dataclass(frozen=True)
class ModelShape:
    """What applying a model has to know beside its weights."""

    categories: tuple[str, ...]
    n_bins: int = 64
    cross_layers: int = 3
    deep_layers: int = 3
    head_layers: int = 2
    embedding_dim: int = 0  # of one source; 0 means a model without text embeddings

    def document(self) -> dict:
        return asdict(self) | {"categories": list(self.categories)}

    @classmethod
    def from_document(cls, document: Mapping) -> ModelShape:
        return cls(**(dict(document) | {"categories": tuple(document["categories"])}))


def resolve_window(cfg: SampleConfig, mode: str) -> tuple[date, date]:
    """Half-open day window ``[start, stop)`` of a ``base_train`` or ``finetune`` split."""
    stop = date.fromisoformat(cfg.stop_date)
    if mode == "finetune":
        return stop - timedelta(days=cfg.finetune_window_days), stop
    if mode == "base_train":
        start = (
            date.fromisoformat(cfg.base_start)
            if cfg.base_start
            else stop - timedelta(days=cfg.base_window_days)
        )
        return start, date.fromisoformat(cfg.base_stop) if cfg.base_stop else stop
    raise ValueError(f"mode must be 'base_train' or 'finetune', got {mode!r}")
