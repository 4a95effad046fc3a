"""The library bound to the driver's tables: registered queries and their oracle SQL."""
