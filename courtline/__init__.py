"""courtline: a PySpark-native box-score warehouse.

Raw all-text game logs and player bios are typed and cleaned (``operators.staging``),
modelled into a star schema (``operators.facts``, ``operators.dims``), enriched with
career products (``operators.derived``), checked (``operators.checks``) and measured
(``operators.measures``).  Everything is a DataFrame transformation; Catalyst plans it.
"""

from courtline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
