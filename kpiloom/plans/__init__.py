"""Plans: compositions of operators into the platform's models and queries."""
