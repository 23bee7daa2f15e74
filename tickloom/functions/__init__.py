"""Column -> Column helpers; everything stays inside JVM expressions."""
