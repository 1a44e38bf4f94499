"""Receivables analytics on Spark: clean, settle, profile, train, score.

Every function takes DataFrames and returns DataFrames. The tenant
(``ad_client_id``) is a column in every key, so one job serves all tenants.
"""

from .params import Params

__all__ = ["Params"]
