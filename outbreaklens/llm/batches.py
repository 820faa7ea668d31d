"""Size of the Arrow batches that carry texts to Python."""

from outbreaklens.session import BATCH_BYTES, bound_batches

__all__ = ["BATCH_BYTES", "bound_batches"]
