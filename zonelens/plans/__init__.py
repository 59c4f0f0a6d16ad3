"""Plans made of several operators, and the profiles they use."""
