"""Named queries over the given tables, each with the SQL that states its result."""

from stayline.contract.modelling import QUERIES as _MODELLING
from stayline.contract.retention import QUERIES as _RETENTION
from stayline.contract.returning import QUERIES as _RETURNING
from stayline.contract.staff import QUERIES as _STAFF

ALL = {**_RETENTION, **_RETURNING, **_STAFF, **_MODELLING}
