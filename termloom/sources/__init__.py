"""Where documents come from: file trees and tables."""
