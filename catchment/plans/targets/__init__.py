"""The target products, each one lazy plan from series to bounds."""
