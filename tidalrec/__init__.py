"""tidalrec: two-stage recommendation analytics expressed as Spark DataFrame jobs."""

from tidalrec.session import get_session, checkpoint_dir
from tidalrec.spec import FeatureSpec

__all__ = ["get_session", "checkpoint_dir", "FeatureSpec"]
