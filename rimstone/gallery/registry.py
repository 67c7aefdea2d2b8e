"""All registered queries by name."""

from __future__ import annotations

from rimstone.gallery import checks, keys, layout, ledger, notes, silver
from rimstone.gallery.base import Registered

REGISTRY: Registered = {
    **silver.QUERIES,
    **checks.QUERIES,
    **keys.QUERIES,
    **ledger.QUERIES,
    **layout.QUERIES,
    **notes.QUERIES,
}
