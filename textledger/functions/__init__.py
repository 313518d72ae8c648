"""Column builders: every function takes and returns Columns."""

from .keys import content_key, epoch_date, hash_identifier, message_key, packed, period_of, raw_id, time_parts, unpacked
from .pinning import pin
from .tagging import first_label, is_noise, label_array, sender_key, sender_tag
from .text import extract_amount, extract_balance, mask_accounts, sanitize_body, view_amount, wide_amount, wide_balance

__all__ = [
    "content_key", "epoch_date", "extract_amount", "extract_balance", "first_label", "hash_identifier",
    "is_noise", "label_array", "mask_accounts", "message_key", "packed", "period_of", "pin", "raw_id", "sanitize_body", "sender_key",
    "sender_tag", "time_parts", "unpacked", "view_amount", "wide_amount", "wide_balance",
]
