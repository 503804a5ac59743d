"""loadcast: Spark-native feature, forecast and evaluation jobs for hourly load series.

Every public function takes and returns Spark DataFrames (or Columns) and runs no action
unless its docstring says so. Sub-packages:

* ``sources``   - table/CSV/JSON/XML readers and table/CSV writers
* ``functions`` - Column-level helpers (parsing, normalisation, calendar parts)
* ``operators`` - reusable DataFrame operators (reshape, spine, windows, splits, joins)
* ``plans``     - the user-level jobs composed from the operators (features, gold, evaluation, delivery, ML)
"""

from loadcast.session import get_session, pin_session

__all__ = ["get_session", "pin_session"]
