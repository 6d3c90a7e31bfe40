from .dedup import keep_first
from .keys import dense_keys
from .ranking import percent_ranks, top_ranked
from .report import numbered, unpivot_counts

__all__ = ["dense_keys", "keep_first", "numbered", "percent_ranks", "top_ranked", "unpivot_counts"]
