"""Ready-made plans: canonical transforms, scoring, views, reports and the registered queries."""
