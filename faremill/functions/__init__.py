from faremill.functions.labels import (
    daypart,
    decode,
    hour_label,
    money_label,
    month_label,
    period_text,
    share,
)

__all__ = ["daypart", "decode", "hour_label", "money_label", "month_label", "period_text", "share"]
