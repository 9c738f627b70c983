"""Ready-made plans: résumé features, salary regression, seniority classification."""
