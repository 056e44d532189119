"""Import every catalog module so its queries register."""

from keepcurve.plans import (  # noqa: F401
    catalog_eval,
    catalog_features,
    catalog_fits,
    catalog_models,
    catalog_sinks,
    catalog_sketches,
    catalog_survival,
    catalog_uplift,
)
