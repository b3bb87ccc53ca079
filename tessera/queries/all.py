"""Import every query family so that each registers its keys."""

from tessera.queries import SQL, REGISTRY  # noqa: F401
from tessera.queries import items  # noqa: F401
from tessera.queries import shapes  # noqa: F401
from tessera.queries import joins_graph  # noqa: F401
from tessera.queries import docs_search  # noqa: F401
from tessera.queries import logs_flows  # noqa: F401
