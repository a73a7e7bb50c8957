"""The star, the feeds it is fed from here, and the registered queries."""
