"""Layer plans: bronze, silver and the fourteen gold tables."""
