"""Silver tables, staging views, marts, the test suite, and the run that ties them together."""
