"""The continuous job: landing folder to gold tables."""
