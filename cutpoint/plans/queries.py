"""All registered queries, in one mapping."""

from cutpoint.plans import catalog, extras, models, registry, reports, serving

QUERIES = {**catalog.QUERIES, **registry.QUERIES, **models.QUERIES, **extras.QUERIES,
           **serving.QUERIES, **reports.QUERIES}
