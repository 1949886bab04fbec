"""The operators as continuously running queries."""
