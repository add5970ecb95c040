"""Whole jobs made of the operators."""

from washline.plans.landing import land_and_verify, verify_landing
from washline.plans.profiles import update_profile
from washline.plans.publish import publish_clean, publish_raw
from washline.plans.store_transactions import clean_store_transactions

__all__ = [
    "clean_store_transactions",
    "land_and_verify",
    "publish_clean",
    "publish_raw",
    "update_profile",
    "verify_landing",
]
