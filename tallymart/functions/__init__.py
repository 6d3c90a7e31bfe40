from .exact import mean, money, percent, ratio
from .mapping import channel_of, payment_status_of, segment_of, tier

__all__ = [
    "channel_of", "mean", "money", "payment_status_of", "percent", "ratio", "segment_of", "tier",
]
